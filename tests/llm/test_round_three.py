"""MinHash near-dedup, centroid clustering and tokenizer alignment against brute force, with nulls, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import alignment, bpe, clusters, minhash, pages, quality
from tidewatch.llm.common import ready

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, rid string, node string, root string, bucket string, same string, "
    "prints string, members string, pairs string, times string, low string, kept string, component_id string, n_a string, i string, chunk string"
)
CLASH = ("x",) * 15


def rooted(pairs, nodes):
    """The smallest node of each node's component."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


# MinHash near-dedup


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset((w,) for w in words)


def near_texts():
    """Copies, near copies around the threshold, chains whose ends are not linked, hot parts shared by many, and short texts."""
    rng = random.Random(12)
    word = lambda: f"w{rng.randint(0, 3000)}"
    rows = []
    shared = [word() for _ in range(60)]
    for i in range(40):  # half of each is one passage: hot bands whose members are not linked
        rows.append((i, " ".join(shared + [word() for _ in range(60)])))
    base = [word() for _ in range(200)]
    rows += [(100 + i, " ".join(base[:i] + ["new"] + base[i + 1 :])) for i in range(0, 200, 5)]  # one large group of near copies
    chain = [word() for _ in range(240)]
    rows += [(600 + i, " ".join(chain[10 * i : 10 * i + 120])) for i in range(12)]  # neighbours are linked, others are not
    edge = [f"e{n}" for n in range(91)]  # 90 shingles
    rows += [(300, " ".join(edge)), (301, " ".join(edge[:81])), (302, " ".join(edge + [f"f{n}" for n in range(10)]))]
    rows += [(303, " ".join(edge[:73])), (304, " ".join(edge[:72])), (305, " ".join(edge[:71]))]  # 72 of 90 is at the threshold
    rows += [(400, "One"), (401, "oNE"), (402, "two"), (403, "one two"), (404, "a b c d e f"), (405, "a b c d e"), (406, "ÀÉ straße"), (407, "àé straße")]
    rows += [(410, None), (411, ""), (412, " \n\t"), (413, None), (413, None)]
    rows += [(100, rows[40][1]), (100, rows[40][1]), (None, rows[45][1]), (None, "no id here at all"), (None, "no id here at all")]
    rows.append((500, " ".join(word() for _ in range(40000))))
    return rows


@pytest.mark.parametrize("cell_rows", [1024, 3])
def test_minhash_groups(spark, cell_rows):
    rows = near_texts()
    sets = [shingle_set(t) for _, t in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    root = rooted(links, range(len(rows)))
    low = {}
    for n, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[root[n]] = min(low.get(root[n], doc_id), doc_id)
    want = Counter()
    for n, (doc_id, _) in enumerate(rows):
        name = low.get(root[n])
        want[(doc_id, len(sets[n]), name, doc_id == name)] += 1
    frame = ready(spark).createDataFrame([(i, t, "en", "s", 1, *CLASH) for i, t in rows], SCHEMA).repartition(3)
    got = minhash.near_groups(frame, cell_rows=cell_rows).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == want
    assert len({r.component_id for r in got if r.doc_id is not None and 600 <= r.doc_id < 612}) == 1


def test_minhash_of_nothing(spark):
    frame = ready(spark).createDataFrame([], SCHEMA)
    assert minhash.near_groups(frame).collect() == []
    assert minhash.near_groups(ready(spark).createDataFrame([(1, None)], "doc_id long, text string")).first().component_id == 1


def test_signatures_estimate_similarity():
    rng, shingles = np.random.default_rng(1), minhash.Shingles(2)
    off = []
    for _ in range(60):
        both = [f"b{x}" for x in rng.integers(0, 1 << 40, 400)]
        left, right = (shingles.of(" ".join(both + [f"{s}{x}" for x in range(60)]).encode()) for s in "lr")
        true = len(np.intersect1d(left, right)) / len(np.union1d(left, right))
        off.append((minhash.signature(left) == minhash.signature(right)).mean() - true)
    assert abs(np.mean(off)) < 0.015 and np.std(off) < 0.05


def test_posterior_bounds():
    """The table against the posterior summed up numerically."""
    grid = (np.arange(200_000) + 0.5) / 200_000
    for number, least in enumerate(minhash.least_matches(80, 1e-6)):
        n = (number + 1) * minhash.BATCH
        for m, kept in ((least, True), (least - 1, False)):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            weight = np.exp(log - log.max())
            assert (weight[grid >= 0.8].sum() / weight.sum() >= 1e-6) == kept


# Quality classifier: what reaches the driver


def test_the_sample_is_bounded(spark, monkeypatch):
    """3,000 rows of one id and a very long text: one bag of each id, passages spread over the text, whatever the order of rows."""
    bags = []
    monkeypatch.setattr(quality, "fit", lambda x, y: bags.append((x, y.tolist())))
    rows = [(1, f"text {n}") for n in range(3000)] + [(n, f"other {n} " * 9) for n in range(2, 20)] + [(20, "long text. " * 40_000), (21, None)]
    labels = spark.createDataFrame([(n, n % 2) for n in range(1, 22)], "doc_id long, quality int")
    for shuffled in (0, 1):
        frame = ready(spark).createDataFrame(random.Random(shuffled).sample(rows, len(rows)), "doc_id long, text string").repartition(5)
        quality.train(frame, labels, sample=2)
        quality.train(frame, labels, most_passages=8)
    (two, _), (more, marks), *again = bags
    assert len(two) == 2 and len(more) == len(marks) > 10
    assert max(len(b) for b in more) <= 8
    assert all((a == b).all() for x, y in zip((two, more), (again[0][0], again[1][0])) for a, b in zip(x, y))


# Malformed pages


@pytest.mark.parametrize("part", ["<a ", "<a b='", "<!--", "<!-- > ", "<!", "</", "<?", "<", "&#"])
@pytest.mark.parametrize("end", ["", ">", "'>x"])
def test_malformed_pages_take_linear_time(part, end):
    from time import process_time

    def seconds(size):
        began = process_time()
        assert pages.page_lines("<p>first</p>" + part * (size // len(part)) + end)[0][1].startswith("first")
        return process_time() - began

    assert seconds(400_000) < max(2.0, 12 * seconds(100_000))


def test_what_the_end_cuts_off_has_no_text():
    assert pages.page_lines("<p>a</p><p>b <a href='x") == [(False, "a"), (False, "b")]
    assert pages.page_lines("<p>a</p><!-- gone > <p>b") == [(False, "a")]
    assert pages.page_lines("x < y <p>1 <2") == [(False, "x < y"), (False, "1 <2")]


# Centroid clustering


def brute_clusters(rows, k=8, rounds=10, dims=64, scale=1024):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    numbers = [[int(np.floor(scale * float(np.float32(x)))) for x in v] for _, v in kept]
    digest = lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest()
    first = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, digest(kept[n][0]), numbers[n]))[:k]
    centroids = [numbers[n] for n in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for v in numbers:
            groups[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(centroids)]
    found = [(i, *nearest(v)) for (i, _), v in zip(kept, numbers)]
    per = Counter()
    for _, d, j in found:
        per[j] += d
    total = sum(per.values())
    return Counter((i, j, d, per[j], total, hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, d, j in found)


def vectors(n=150, seed=5):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, 64))
    rows = [(int(i), [float(np.float32(x)) for x in centers[i % 5] + 0.4 * rng.normal(size=64)]) for i in range(n)]
    one = rows[7][1]
    rows += [(7, one), (7, one), (None, one), (None, rows[8][1]), (900, None), (901, one[:63]), (902, [*one, 0.0]), (903, [])]
    rows += [(904, [None, *one[1:]]), (905, [float("nan"), *one[1:]]), (906, [float("inf"), *one[1:]]), (907, [0.0] * 64), (908, [-1e4] * 64)]
    return rows


VECTORS = "vec_id long, embedding array<float>, block string, shard string, cluster string, h string, at string"


@pytest.mark.parametrize("settings", [{}, {"shard": 10, "block_rows": 7}])
def test_clusters(spark, settings):
    rows = vectors()
    frame = ready(spark).createDataFrame([(*r, *"abcde") for r in rows], VECTORS).repartition(3)
    got = Counter(tuple(r) for r in clusters.clustered(frame, **settings).collect())
    assert got == brute_clusters(rows)


def test_few_vectors_and_empty_clusters(spark):
    rows = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [0.25] * 64)]  # equal centroids: the second one stays empty
    frame = ready(spark).createDataFrame([(*r, *"abcde") for r in rows], VECTORS)
    assert Counter(tuple(r) for r in clusters.clustered(frame).collect()) == brute_clusters(rows)
    assert clusters.clustered(frame.limit(0)).collect() == []
    assert clusters.clustered(frame.where("vec_id = 1").withColumn("embedding", frame.embedding.cast("array<double>"))).first().distance == 0


def test_vectors_beyond_exact_distances(spark):
    frame = ready(spark).createDataFrame([(1, [1e9] * 64), (2, [0.0] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="64 bits"):
        clusters.clustered(frame)


def test_clusters_sql(spark, tmp_path):
    rows = [r for r in vectors(60, 6) if r[0] != 7 and r[0] is not None]
    path = f"{tmp_path}/embeddings.parquet"
    frame = ready(spark).createDataFrame(rows, "vec_id long, embedding array<float>")
    frame.write.parquet(path)
    base = duckdb.connect()
    base.register("embeddings", frame.toPandas())
    got = base.execute(clusters.ORACLE["op12_clusters"]).fetchall()
    assert Counter(got) == brute_clusters(rows)


# Tokenizer alignment


def aligned_texts():
    rng = random.Random(2)
    words = "The quick-brown fox's naïve café résumé 12345 don't über Straße ... (see) http://x.y/z?a=b\n\nNew\tline 你好 世界 🙂🙂 <s> </s> <|endoftext|> <unk> ▁x".split(" ")
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, " "), (53, "   leading"), (54, "trailing   "), (55, "\n"), (56, "a" * 3000), (57, "x " * 1500), (58, " 　ﬁ")]
    rows += [(59, "the same"), (59, "the same"), (None, "the same"), (60, "é \u0000 ﻿"), (61, "  two  spaces  ")]
    return rows


def brute_alignment(rows, tokenizers):
    one = alignment.Aligner(*tokenizers)
    docs, held = [], Counter()
    for doc_id, text in rows:
        tokens = [x[0].tolist() for x in one.encode([text])] if text else ([], [])
        spans = []
        for ids, table in zip(tokens, (one.bytes_a, one.bytes_b)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(out)
        whole = b" " + (text or "").encode()
        if not text or any(b"".join(t[i] for i in ids) != whole for ids, t in zip(tokens, (one.bytes_a, one.bytes_b))):
            docs.append((doc_id, None))
            continue
        a, b = spans
        ends = sorted({x[1] for x in a} & {x[1] for x in b})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s and e <= end) for side in spans))
            start = end
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]] if len(a) < 500 else near_links(a, b)
        docs.append((doc_id, (len(a), len(b), groups, links)))
        held.update(set(links))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = Counter()
    for doc_id, found in docs:
        if found is None:
            out[(doc_id, 0, 0, 0, 0, 0, 0, "")] += 1
        else:
            n_a, n_b, groups, links = found
            best = sum(held[x] == most[x[0]] for x in links)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            out[(doc_id, n_a, n_b, len(groups), len(links), best, sum(held[x] for x in links), digest)] += 1
    return out


def near_links(a, b):
    """All overlapping pairs of long texts: for each token of A those of B that end after its start, up to its end."""
    ends, out = np.array([y[1] for y in b]), []
    for start, end, i in a:
        at = int(np.searchsorted(ends, start, "right"))
        while at < len(b) and b[at][0] < end:
            out.append((i, b[at][2]))
            at += 1
    return out


@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers

    return alignment.read_tokenizers(*(public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")))


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 5, 0])
def test_alignment(spark, tokenizers, frequent):
    rows = aligned_texts()
    frame = ready(spark).createDataFrame([(i, t, "en", "s", 1, *CLASH) for i, t in rows], SCHEMA).repartition(3)
    got = Counter(tuple(r) for r in alignment.align_tokenizers(frame, tokenizers, frequent=frequent).collect())
    assert got == brute_alignment(rows, tokenizers)
    assert alignment.align_tokenizers(frame.limit(0), tokenizers, frequent=frequent).collect() == []


def test_window_memory_does_not_change_results(tokenizers, monkeypatch):
    """With a memory of three windows, and texts one by one or together."""
    texts = [t for _, t in aligned_texts() if t]
    plain = alignment.Aligner(*tokenizers)
    want = plain.documents(texts, plain.encode(texts))
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    short = alignment.Aligner(*tokenizers)
    at = np.cumsum(want.n_pairs) - want.n_pairs
    for n, text in enumerate(texts):
        got, own = short.documents([text], short.encode([text])), slice(at[n], at[n] + want.n_pairs[n])
        assert (got.groups[0], got.n_groups[0], got.n_links[0]) == (want.groups[n], want.n_groups[n], want.n_links[n])
        assert got.pairs.tolist() == want.pairs[own].tolist() and got.times.tolist() == want.times[own].tolist()
    assert sum(x is not None for x in want.groups) > 15


def test_ranks_give_the_ids_of_the_vocabulary(tokenizers):
    """Every character in several surroundings, and the texts above, by both libraries."""
    one = alignment.Aligner(*tokenizers)
    assert one.ranked is not None
    texts = [f" a{c}b 1{c}2 {c}{c} .{c}!{c}'s\n{c} " for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    texts = texts[:0x3400] + texts[0x3400::9] + [f" {t}" for _, t in aligned_texts() if t]
    assert [x.ids for x in one.a.encode_batch_fast(texts, add_special_tokens=False)] == [x.tolist() for x in one.encode([t[1:] for t in texts])[0]]


def test_other_vocabularies_use_their_own_library(tokenizers):
    import json

    told = json.loads(tokenizers[0])
    told["pre_tokenizer"]["add_prefix_space"] = True
    other = alignment.Aligner(json.dumps(told), tokenizers[1])
    assert other.ranked is None and other.encode(["x y"])[0][0].tolist() == alignment.Aligner(*tokenizers).encode(["x y"])[0][0].tolist()


def test_byte_alphabet():
    from tokenizers import pre_tokenizers

    assert sorted(alignment.byte_alphabet()) == sorted(pre_tokenizers.ByteLevel.alphabet())
    assert sorted(alignment.byte_alphabet().values()) == list(range(256))


def test_ranks_found_by_check_sum_alone_change_nothing(spark, monkeypatch):
    words = ready(spark).createDataFrame([(" thoreror",), (" otherword",), ("x",), ("naïve日本",)], "word string")
    encodings = []
    for buckets in (bpe._TOKEN_BUCKETS, 1 << 9):  # in 512 buckets about a hundred tokens share each check sum
        monkeypatch.setattr(bpe, "_TOKEN_BUCKETS", buckets)
        codec = bpe.public_codec()
        encodings.append({r.word: r.ids for r in words.select("word", codec.fold(F.col("word")).alias("ids")).collect()})
    assert encodings[0] == encodings[1] and len(encodings[0]) == 4
    # A word's parts are looked up, not compared with the tokens one by one.
    assert "array_position" not in str(codec.fold(F.col("word")))
