"""Operators on small tables with nulls, empty and long texts, repeated rows and columns whose names clash, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tidewatch.llm import bpe, exact_dedup, licenses, mixing, pages, pii, quality, simhash, token_counts, topk
from tidewatch.llm.common import components, ready

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, rid string, row string, key string, block string, fp string, "
    "cell string, size string, ids string, word string, found string, score string, name string, sid string, pos string"
)
CLASH = ("x",) * 14


def words(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randint(0, 40)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for i in range(60):
        out.append((i, words(rng, rng.randint(1, 120)), "en", f"s{i % 4}", 3, *CLASH))
    base = words(rng, 400)
    out += [(100, base, "en", "s0", 1, *CLASH), (101, base.upper(), "en", "s1", 1, *CLASH), (101, base.upper(), "en", "s1", 1, *CLASH)]
    out += [(102, base + " tail", "en", None, 1, *CLASH), (103, base.replace("alpha1 ", "alpha2 ", 1), None, "s1", None, *CLASH)]
    out += [(104, None, None, None, None, *CLASH), (105, "", "en", "s2", 0, *CLASH), (106, " \n\t", "en", "s2", 3, *CLASH)]
    out += [(None, "no id", "en", "s3", 5, *CLASH), (107, "ÀÉ Straße ÀÉ", "de", "s3", 5, *CLASH), (108, words(rng, 9000), "en", "s0", 9, *CLASH)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return ready(spark).createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return ready(spark).createDataFrame([], SCHEMA)


def lower(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("settings", [{}, {"block_bytes": 32, "key_bits": 5}])
def test_exact_groups(docs, rows, settings):
    """With keys of 5 bits most blocks share their key with others, so names come from contents."""
    groups = defaultdict(list)
    for row in rows:
        groups[lower(row[1])].append(row[0])
    got = exact_dedup.exact_groups(docs, **settings).collect()
    low = lambda x: -1 if x is None else x
    want = Counter()
    for text, ids in groups.items():
        for i in ids:
            want[(i, max(ids, key=low), len(ids), hashlib.sha256(text).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    assert sorted(exact_dedup.drop_exact(docs, **settings).select("doc_id").toPandas().doc_id.fillna(-1)) == sorted(low(r.doc_id) for r in kept)


def brute_fingerprint(text):
    w = lower(text).split()
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_near_groups(docs, rows):
    prints = [(r[0], brute_fingerprint(r[1])) for r in rows]
    label = {fp: fp for _, fp in prints}
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                if (a ^ b).bit_count() <= 4 and label[b] < label[a]:
                    label[a], changed = label[b], True
    low = {}
    for doc_id, fp in prints:
        if doc_id is not None:
            low[label[fp]] = min(low.get(label[fp], doc_id), doc_id)
    want = Counter((doc_id, format(fp, "016x"), low.get(label[fp])) for doc_id, fp in prints)
    for settings in ({}, {"cell_rows": 4}):
        got = simhash.near_groups(docs, **settings).collect()
        assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    stay = simhash.drop_near(docs).collect()
    assert len(stay) == len({c for _, _, c in want})


def test_drop_near_without_telling_ids(spark):
    """Null and repeated ids: one row of each component stays, whatever the ids of the others are."""
    import corpus_pipeline

    rng = random.Random(8)
    texts = [words(rng, 40) for _ in range(12)]
    rows = [(None, t, n) for n, t in enumerate(texts[:4])]  # different texts, no id
    rows += [(5, texts[4], 10), (None, texts[4], 11), (None, texts[4], 12)]  # named by an id
    rows += [(6, texts[5], 20), (6, texts[6], 21), (6, texts[6], 22)]  # one id in two components
    rows += [(None, texts[7], 30), (None, texts[7].upper(), 31)] + [(7, None, 40), (8, "", 41)]
    frame = ready(spark).createDataFrame(rows, "doc_id long, text string, mark long").repartition(3)
    members = defaultdict(list)
    for doc_id, text, mark in rows:
        members[brute_fingerprint(text)].append((doc_id, mark))
    assert all((a ^ b).bit_count() > 4 for a in members for b in members if a != b)
    got = corpus_pipeline.without_near_copies(spark, frame, "").collect()
    assert len(got) == len(members) == 9 and Counter(rows) >= Counter(tuple(r) for r in got)
    for r in got:
        ids = [i for i, _ in members.pop(brute_fingerprint(r.text)) if i is not None]
        assert r.doc_id == min(ids, default=None)


def test_every_link_meets_at_an_anchor():
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = fps.copy()
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    row, anchor, home = simhash.anchors_of(np.concatenate([fps, near]))
    places, homes = defaultdict(set), defaultdict(set)
    for r, a, h in zip(row.tolist(), anchor.tolist(), home.tolist()):
        assert a not in places[r]
        places[r].add(a)
        if h:
            homes[r].add(a)
    assert all(len(h) == 3 for h in homes.values())
    assert all(homes[i] & places[i + 300] and homes[i + 300] & places[i] for i in range(300))


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}


def test_quality(spark, docs, nothing):
    rng = random.Random(8)
    good = [(i, ". ".join(words(rng, 9) for _ in range(rng.randint(1, 30)))) for i in range(150)]
    bad = [(1000 + i, "!! ".join(w.upper() for w in words(rng, rng.randint(20, 300)).split())) for i in range(100)]
    train = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad] + [(3, None), (5, 0), (None, 1)], "doc_id long, quality int")
    model = quality.train(train, labels)
    got = {r.doc_id: r.score for r in quality.scored(train, model).collect()}
    assert all((got[i] >= quality.THRESHOLD) == (i < 1000) for i in got if i != 5)
    edge = quality.scored(docs, model).collect()
    assert len(edge) == docs.count() and all(0 <= r.score <= 1 for r in edge)
    assert quality.scored(nothing, model).count() == 0
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.train(train, labels.where("quality = 1")) == {"constant": 1.0}
    assert quality.train(nothing, labels) == {"constant": 0.5}


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 3 * sizes[s]}
        if not over:
            return target | {s: share * weight[s] for s in open_}
        for s in over:
            target[s], left = 3.0 * sizes[s], left - 3 * sizes[s]
        open_ -= over
    return target


def test_mixing(docs, rows):
    got = mixing.mixed_counts(docs, block_words=4, shard_words=500).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], size(r[1])) for r in rows)
    by_source = defaultdict(int)
    for row in rows:
        by_source[row[3]] += size(row[1])
    want, taken = brute_targets(by_source), defaultdict(int)
    source = {(r[0], size(r[1])): r[3] for r in rows}
    for r in got:
        s = source[r.doc_id, r.size]
        taken[s] += r.taken
        assert r.source_size == by_source[s] and r.target == pytest.approx(want[s]) and r.taken <= 3 * r.size
    assert all(abs(taken[s] - want[s]) <= 12 for s in want)
    again = mixing.mixed_counts(docs.repartition(5), block_words=4, shard_words=500).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mixed_documents(docs, rows):
    sizes = Counter()
    for r in mixing.mixed_counts(docs, block_words=4).collect():
        sizes[r.doc_id] += r.taken
    made = mixing.mixed_documents(docs, block_words=4)
    assert made.columns == docs.columns
    got = Counter()
    whole = {r[0]: (r[1] or "") for r in rows}
    for r in made.collect():
        got[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text) and set(r.text.split()) <= set(whole[r.doc_id].split())
    assert {k: v for k, v in sizes.items() if v} == dict(got)


def test_permutation(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 100):
        keys = F.array(*[F.lit((i * 7919 + 13) % n) for i in range(mixing.ROUNDS)])
        got = spark.range(n).select(mixing._permuted(F.col("id"), keys, F.lit(n)).alias("x")).collect()
        assert sorted(r.x for r in got) == list(range(n))


TEXTS = [None, "", " ", "Hello  world's\n\n end", "naïve 日本語 🙂🙂 123,456", "a" * 700, "\u00a0\u2003x \u0085", "it's I'LL we've", "\t\tif x:\r\n", " " * 40 + "z"]


def test_bpe_is_the_library(spark):
    import public_tokenizers
    import tiktoken

    codec = bpe.public_codec()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rng = random.Random(6)
    texts = TEXTS + ["".join(rng.choice("ab cZ'\n\t 0１é 　🙂日-.!sre") for _ in range(rng.randint(0, 60))) for _ in range(100)]
    frame = ready(spark).createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, word string")
    for most in (0, 30):
        for r in bpe.digests(frame, codec, most).collect():
            text = texts[r.doc_id] or ""
            ids = library.encode_ordinary(text)
            assert r.n_tokens == len(ids), text
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_ill_formed_ranks():
    with pytest.raises(ValueError):
        bpe.merges_of({b"a": 0, b"b": 1, b"c": 2, b"abc": 3})


def test_token_counts_are_the_library(spark):
    import public_tokenizers
    import sentencepiece
    from pyspark.sql import functions as F

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, pieces = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.read_pieces(path)
    rng = random.Random(7)
    parts = ["a", "the", "  ", " ", "▁", "\n", "\t", "é", "日", "🙂", "<s>", "</s>", "<0x0A>", "1", ".", "ing", "\x00", "er"]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(150)]
    frame = ready(spark).createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    for r in token_counts.counted(frame, pieces, limit=5).collect():
        text = texts[r.doc_id] or ""
        counts = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), counts[-1], counts[-1] > 5)
        assert r.n_chars_within == max(i for i, n in enumerate(counts) if n <= 5)
    table = token_counts.prefix_table(frame, pieces)
    asked = table.select("doc_id", "counts", token_counts.longest_within(F.col("counts"), F.lit(5)).alias("fits"), token_counts.tokens_of_prefix(F.col("counts"), F.lit(9)).alias("nine"))
    for r in asked.collect():
        text = texts[r.doc_id] or ""
        counts = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        assert r.counts == counts and r.fits == max(i for i, n in enumerate(counts) if n <= 5) and r.nine == counts[min(9, len(text))]


def test_topk(spark):
    rng = random.Random(5)
    vectors = {i: [rng.choice([-1.0, -0.25, 0.0, 0.5, 1.0]) for _ in range(6)] for i in range(130)}
    rows = [(i, v, "x") for i, v in vectors.items()] + [(50, vectors[50], "x"), (500, None, "x"), (501, [None] * 6, "x"), (502, [float("nan")] * 6, "x"), (None, [1.0] * 6, "x"), (550, [float("inf")] + [0.0] * 5, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string")
    whole = {i: [int(x * 256 // 1) for x in v] for i, v in vectors.items()}
    want = set()
    for q in whole:
        if q % 50 == 0:
            ranked = sorted((-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in whole if c != q)
            want |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(ranked[:5])}
    for settings in ({}, {"candidate_rows": 20, "query_rows": 2, "first": 0.1}, {"candidate_rows": 3}):
        assert set(map(tuple, topk.top_k(frame, "vec_id % 50 = 0", **settings).collect())) == want
    assert topk.top_k(frame.limit(0), "vec_id % 50 = 0").count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(2)
    values, weights = rng.integers(-9, 10, (40, 5)).astype(float), rng.integers(-9, 10, (7, 5)).astype(float)
    exact = weights @ values.T
    for depth in (1, 10, 39):
        least, most = topk.bounds(values, weights, depth)
        assert (least <= exact).all() and (exact <= most).all()


def test_licenses(spark, nothing):
    texts = [
        None, "", "Released under the MIT License.", "MIT license; the MIT-License and mit license", "licensed under the Apache license version two",
        "this work is licensed under the GNU general public license version 3 " * 2, "x " * 500 + "Licensed under CC BY-NC 4.0", "released mit the under nothing license",
        "general public license", "permission is hereby granted, free of charge",
    ]
    frame = ready(spark).createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(2, texts[2], "x")], "doc_id long, text string, base string")
    got = licenses.license_scan(frame).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(texts[r.doc_id]).decode())
        places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        shares = {
            n: max(len(set(t.split()) & set(w[i : i + licenses.WINDOW])) / len(set(t.split())) for i in range(0, max(1, len(w)), licenses.STEP)) for n, (_, t) in enumerate(licenses.TEMPLATES)
        }
        met = {licenses.TEMPLATES[n][0]: share for n, share in shares.items() if share >= licenses.THRESHOLD}
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and r.labels == ",".join(sorted({x for _, x in places} | set(met)))
        assert r.score == pytest.approx(1.0 if places else max(met.values(), default=0.0))
    assert licenses.license_scan(nothing).count() == 0


def test_templates_name_their_license(spark):
    """Sentences of other licenses do not meet a template by its common words."""
    texts = {
        "released under the BSD license": "", "released under the Apache License": "apache", "released under the MIT license": "mit", "licensed under CC BY 4.0": "",
        "licensed under CC BY-SA 4.0": "", "licensed under CC BY-NC 4.0": "cc-by-nc", "this work is licensed under the GNU free documentation license version 3": "",
        "this source code form is subject to the terms of the Eclipse Public License": "", "this source code form is subject to the terms of the Mozilla Public License": "mpl",
    }
    frame = ready(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {list(texts)[r.doc_id]: r.labels for r in licenses.license_scan(frame).collect()} == texts


def test_pseudonyms(spark):
    from pyspark.sql import functions as F

    values = {
        "anna.34@mail7.example.com": "email", "9807915762804490": "number", "4111 1111 1111 1111": "number", "+1 (017) 555-7713": "phone", "97.51.17.173": "ip",
        "2024-02-29": "date", "31/12/1999": "date", "123-45-6789": "ssn", "b44e15e09fd311c3cf3163b66d5a9875b883d8ce": "secret", "DE89 3704 0044 0532 0130 00": "account",
    }
    texts = [None, "", "nothing to see", "256.1.1.1 and 1.2.3 and 666-45-6789", "on 2024-02-30"] + [f"It was {v}, twice: {v}!" for v in values]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, found string")
    got = {r.row.doc_id: r for r in pii.pseudonymised(frame).select("row", "masked", F.transform("found", pii.kind_of).alias("kinds")).collect()}
    assert all(got[i].masked == texts[i] for i in range(5))
    for i, (value, kind) in enumerate(values.items(), 5):
        first, second = re.fullmatch(r"It was (.*), twice: (.*)!", got[i].masked).groups()
        assert first == second != value and got[i].kinds == [kind, kind]
        assert re.sub(r"[0-9a-z]", "_", first) == re.sub(r"[0-9a-z]", "_", value) or kind in ("ip",)
    digits = [int(x) for x in re.sub(r"\D", "", re.search(r"was (.*), twice", got[7].masked)[1])]
    total = sum(sum(divmod(2 * d, 10)) if (len(digits) - i) % 2 == 0 else d for i, d in enumerate(digits))
    assert total % 10 == 0
    account = re.search(r"was (.*), twice", got[14].masked)[1].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def test_pseudonyms_are_permutations(spark):
    from pyspark.sql import functions as F

    days = spark.range(0, pii._DAYS, 37).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("v"))
    codes = spark.range(900).select(F.format_string("123-%02d-%04d", F.col("id") % 90 + 1, F.col("id") + 1).alias("v"))
    numbers = spark.range(900).select(F.format_string("%013d", "id").alias("v"))
    for frame in (days, codes, numbers):
        row = frame.select("v", pii.pseudonym(F.col("v")).alias("p")).agg(F.countDistinct("v").alias("n"), F.countDistinct("p").alias("m"), F.sum((pii.kind_of(F.col("p")) == pii.kind_of(F.col("v"))).cast("int")).alias("same")).first()
        assert row.n == row.m == row.same


def test_every_email_is_masked(spark):
    """Without a digit, with letters of any script, and longer than one hash."""
    from pyspark.sql import functions as F

    long = [("ab" * 100, "a7" * 200), ("ab" * 99 + "ac", "a7" * 199 + "a8")]
    locals_ = ["jane.doe", "Jane.Doe", "jörg", "žofie.š", "иван.петров", "иван.петроа", "李小龙", "x٣٤", "𝒜𝒷", "é", *(x for pair in long for x in pair)]
    emails = [f"{x}@example.com" for x in locals_]
    texts = [f"write to {e} now" for e in emails] + [f"{e} or call 1" for e in emails]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.row.doc_id: r for r in pii.pseudonymised(frame).select("row", "masked", F.transform("found", pii.kind_of).alias("kinds")).collect()}
    masked = [re.fullmatch("write to (.*) now", got[i].masked)[1] for i in range(len(emails))]
    for i, email in enumerate(emails):
        assert got[i].kinds == got[i + len(emails)].kinds == ["email"]
        assert masked[i] != email and got[i + len(emails)].masked == f"{masked[i]} or call 1"
        local = masked[i].removesuffix("@example.com")
        assert len(local) == len(locals_[i]) and all(ord(a) // 256 == ord(b) // 256 for a, b in zip(local, locals_[i]))
    assert len({m.lower() for m in masked[2:]}) == len(masked) - 2
    for text in locals_[-4:]:  # places beyond the first hash change as well
        new = masked[locals_.index(text)]
        assert sum(a != b for a, b in zip(new[150:200], text[150:200])) > 25
    assert pii.pseudonymised(spark.createDataFrame([(m,) for m in masked], "text string")).select(F.transform("found", pii.kind_of)).distinct().count() == 1
    single = spark.range(0x400, 0x500).select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c")).where(F.col("c").rlike(r"\p{L}"))
    counted = single.select(pii.pseudonym(F.concat("c", F.lit("а@example.com"))).alias("p")).agg(F.count("p").alias("n"), F.countDistinct("p").alias("m")).first()
    assert counted.n == counted.m > 200


def page(nav, body, foot):
    return f"<html><body><div>{nav}</div>" + "".join(f"<p>{x}</p>" for x in body) + f"<div>{foot}</div></body></html>"


def test_pages(spark):
    rows = [(i, f"http://h.example/a/{i}?q=1", page("Home &amp; About", [f"text  {i}\n one", f"text {i} two"], "Copyright"), "x") for i in range(6)]
    rows += [rows[0], (9, "http://other/x", page("Home", ["solo"], "f"), "x"), (10, None, None, "x"), (11, "http://h.example/b", "", "x")]
    article = "<nav>menu</nav><div class='cookie-notice'>ok?</div><article><h1>T &lt;1&gt;</h1><p><b>One<br>two<p>Three<aside>side</aside><script>var x='</p>';</script><section class='comments'><p>me too</p></section></article><form>f</form><footer>foot"
    rows += [(12, "http://h.example/c", article, "x"), (13, "http://h.example/c2", article, "x")]
    frame = ready(spark).createDataFrame(rows, "page_id long, url string, html string, key string")
    got = defaultdict(list)
    for r in pages.main_text(frame).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    for i in range(6):
        assert got[i] == [f"text {i} one\n\ntext {i} two"] * (2 if i == 0 else 1)
    assert got[9] == ["Home\n\nsolo\n\nf"] and got[10] == [""] and got[11] == [""]
    assert got[12] == got[13] == ["T <1>\n\nOne two\n\nThree"]
    assert pages.main_text(frame.limit(0)).count() == 0


def test_differencing_beside_an_article(spark):
    """Where an article is marked, lines outside it go only if the partner has them."""
    html = "<div>Menu</div><article><p>Same</p><p>Own {0}</p></article><div>Written by {0}</div><div>Imprint</div>"
    frame = ready(spark).createDataFrame([(i, f"http://h/{i}", html.format(i)) for i in range(4)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in pages.main_text(frame).collect()} == {i: f"Same\n\nOwn {i}\n\nWritten by {i}" for i in range(4)}


def test_partners_of_copies(spark):
    """Large frames go, and pages of a run of copies are compared with what stands before and after the run."""
    menu = [f"menu {n}" for n in range(20)]
    rows = [(i, f"http://h/a{i}", page("<br>".join(["top"]), menu + [f"own {i} {n}" for n in range(3)], "end")) for i in range(4)]
    rows += [(100 + v, f"http://h/a2b?v={v}", page("top", [*menu, "copied"], "end")) for v in range(40)]
    frame = ready(spark).createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.main_text(frame).collect()}
    assert got == {i: "\n\n".join(f"own {i} {n}" for n in range(3)) for i in range(4)} | {100 + v: "copied" for v in range(40)}
    rng = random.Random(6)
    keys = [(bytes([n // 256, n % 256]), rng.choice([None, "http://a/", "http://b/"]), [rng.choice([1, 1, 1, 1, 2])]) for n in range(400)]
    keys = [(k, u and u + str(n // 40), h if n % 3 else [1]) for n, (k, u, h) in enumerate(keys)]
    order = sorted(("" if u is None else u[7], "" if u is None else u[8:], k, h) for k, u, h in keys)
    order = [(x[0] or None, *x[1:]) for x in order]
    want = {}
    for at, (host, _, key, hashes) in enumerate(order):
        sides = (reversed(order[:at]), order[at + 1 :])
        want[key] = [next(((x[0], x[1], x[3]) for x in side if (x[0], x[3]) != (host, hashes)), None) for side in sides]
    found = pages.partners(spark.createDataFrame(keys, "key binary, url string, hashes array<long>").repartition(3)).collect()
    assert {bytes(r.key): [x and (x.host, x.path, x.hashes) for x in (r.prev, r.next)] for r in found} == want and len(found) == len(keys)


@pytest.mark.parametrize("html, lines", [
    ("<div class='content with-sidebar'><p>a</p></div><div class='layout has-ads'>b</div><article class='post share-enabled'>c</article>", "a b c"),
    ("<div class='site ads'>x</div><div id='cookie-notice'>x</div><p class='ad'>x</p><div role='navigation'>x</div><p>a", "a"),
    ("<html><head><meta charset=utf-8><title>t</title><body><p>a</p>", "a"),
    ("<html><head><title>t</title><div>a</div><p>b", "a b"),
    ("<title>t</title><p>a", "a"),
    ("<p class='ad'>x<p>a</p><p class='ad'>y<div>b</div>", "a b"),
    ("<ul><li class='share'>x<li>a<li class='share'>y</ul>b", "a b"),
    ("<div><span class='ad'>x<b>y</div>a", "a"),
    ("<div class='ad'>x<div>y</div>z</div>a", "a"),
    ("<table><tr><td class='ad'>x<td>a<tr class='ad'><td>y<tr><td>b</table>c", "a b c"),
    ("<nav>x<article>a<aside>y</article>b", "a b"),
    ("<article>a<b><p>b</b>c</article><div>d", "a bc d"),
    ("<select><option>x<option>y</select>a<p>b<script>'</p>'</script>c", "a b c"),
])
def test_where_skipping_ends(html, lines):
    assert " ".join(line for _, line in pages.page_lines(html)) == lines


def test_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 9))] for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        got, rest = pages.shared_lines(a, b), iter(b)
        assert len(got) == best[-1, -1] and all(a[i] in rest for i in got)


def test_empty_tables(nothing):
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert exact_dedup.drop_exact(nothing).count() == 0
    assert simhash.near_groups(nothing).count() == 0
    assert mixing.mixed_counts(nothing).count() == 0
    assert mixing.mixed_documents(nothing).count() == 0
    assert bpe.digests(nothing, bpe.public_codec()).count() == 0
    assert token_counts.counted(nothing, {"a": 0.0}).count() == 0
    assert pii.pseudonymised(nothing).count() == 0


def test_token_counts_try_only_lengths_of_pieces_and_share_prefixes():
    import public_tokenizers

    pieces = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    vocabulary = token_counts.Vocabulary(pieces)
    for tail in ("ing", "the", "é", "日本", "▁a", "zqx", "▁▁▁"):
        ends = {len(p) for p in pieces if p.endswith(tail)} if len(tail) == token_counts.TAIL else set()
        ends |= {len(tail[at:]) for at in range(len(tail)) if tail[at:] in pieces}
        assert vocabulary.lengths_at(tail) == sorted(ends, reverse=True)
    units = ["▁undeinungbepf", "▁undeinungs", "▁undei", "▁und", "▁" * 9, "日本語🙂日本語"]
    alone = [token_counts.Vocabulary(pieces).unit_counts(u) for u in units]
    assert [vocabulary.unit_counts(u) for u in units] == alone and set(vocabulary.heads) == {u[: token_counts.HEAD] for u in units if len(u) > token_counts.HEAD}
    assert [vocabulary.unit_count("q" * 700), vocabulary.unit_count("▁und")] == [token_counts.Vocabulary(pieces).unit_counts("q" * 700)[-1], alone[3][-1]]
    assert set(vocabulary.young) == {"▁und"}  # a worker's memory is bounded in characters too


def test_bpe_dictionary_gives_every_word_a_place_of_its_own(spark):
    import base64
    import zlib

    common = {f"{a}{n}": f"{n},1" for n in range(4000) for a in (" w", "é", "")}
    steps, known, ids = bpe._placed(common)
    for word, joined in common.items():
        upper, lower = divmod(zlib.crc32(word.encode()), 1 << bpe._PLACE_BITS)
        at = lower + steps[upper]
        assert base64.b64decode(known[at]).decode() == word and ids[at] == joined
    assert sum(x is not None for x in known) == len(common) == sum(x is not None for x in ids)
    assert bpe._placed({})[1:] == ([], [])


def test_bpe_ids_are_numbers_and_text(spark):
    codec = bpe.public_codec()
    frame = ready(spark).createDataFrame([(1, "the cat thé"), (2, None)], "doc_id long, text string")
    rows = bpe.encode(frame, codec)
    assert dict(rows.dtypes)["ids"] == "array<int>"
    for r in rows.collect():
        assert r.joined == ",".join(map(str, r.ids)) and bool(r.ids) == bool(r.row.text)


def test_bpe_tables_are_in_no_plan_and_in_no_row(spark, monkeypatch):
    import public_tokenizers
    import tiktoken

    monkeypatch.setattr(bpe, "TIER", 1)
    codec = bpe.public_codec()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    texts = ["the cat the hat", "a cat", None, "the rarest thoreror"]
    frame = ready(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tables = codec.stored(spark)
    assert len(bpe.common_words(frame, codec, tables, 2)) == 2  # two tiers of one word; the other words are folded where they stand
    rows = bpe.digests(frame, codec, 2)
    plan = rows._jdf.queryExecution().optimizedPlan()
    # Neither as text (megabytes before), nor as a column that is copied with each row.
    assert len(plan.toString()) < 20_000 and "scalar-subquery" in plan.toString() and " AS tables#" not in plan.toString()
    for r in rows.collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
