"""Response plans per alert type."""

# Fixed values: (alert type, title, summary, steps).
PLAYBOOKS = [
    (
        "brute_force",
        "Brute Force Response",
        "Validate if the source IP is repeatedly targeting the login flow.",
        [
            "Review the related login attempts and targeted usernames.",
            "Check whether the source IP matches an internal test runner or automation.",
            "Block or throttle the IP if the behavior is malicious.",
            "Reset impacted credentials if a valid account was exposed.",
        ],
    ),
    (
        "sql_injection",
        "SQL Injection Response",
        "Confirm whether the request path or query string contains injection probes.",
        [
            "Inspect the raw endpoint and request metadata for payload patterns.",
            "Verify if the request reached a sensitive route or caused a server error.",
            "Block the source IP and preserve logs for incident follow-up.",
            "Review application sanitization coverage for the affected endpoint.",
        ],
    ),
    (
        "port_scanning",
        "Scanning Response",
        "Assess broad endpoint discovery or reconnaissance behavior.",
        [
            "Inspect the list of unique endpoints touched in the selected time window.",
            "Correlate with user-agent and response codes to confirm reconnaissance.",
            "Apply temporary IP controls if the behavior is sustained.",
            "Review whether newly exposed endpoints need tighter access control.",
        ],
    ),
    (
        "path_traversal",
        "Path Traversal Response",
        "Investigate attempts to access files outside the expected document root.",
        [
            "Validate whether the endpoint contains traversal markers or file disclosure probes.",
            "Confirm that the request did not return protected system file content.",
            "Block the source and preserve request context for further analysis.",
            "Review route sanitization and path normalization defenses.",
        ],
    ),
    (
        "suspicious_user_agent",
        "Suspicious Tooling Response",
        "Identify whether the source is using known offensive tooling.",
        [
            "Confirm the user-agent and endpoints touched by the request set.",
            "Check if the IP overlaps with approved test infrastructure.",
            "Escalate repeated activity to incident handling if it targets sensitive endpoints.",
        ],
    ),
    (
        "time_anomaly",
        "Off-hours Activity Response",
        "Assess unusual request bursts outside expected business hours.",
        [
            "Review whether the IP or user pattern has a legitimate operational reason.",
            "Correlate with other alerts or anomaly scores around the same time.",
            "Escalate only if the activity is sustained or combined with other indicators.",
        ],
    ),
]

# Fixed values: (title, summary, steps) for any other type.
DEFAULT_PLAYBOOK = (
    "Generic Investigation",
    "Use the related logs and anomaly signals to determine whether escalation is required.",
    [
        "Review timestamps, IP, endpoint, and severity for the selected item.",
        "Pivot into related logs and anomaly scores to understand surrounding behavior.",
        "Escalate if multiple indicators align or if the affected asset is sensitive.",
    ],
)
