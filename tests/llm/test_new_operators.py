"""Source audit, importance resampling and edit fingerprints, against plain versions and on odd inputs."""

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dialtide.llm import edit_fingerprints, importance, source_audit  # noqa: E402
from dialtide.llm.edit_fingerprints import document_fingerprints  # noqa: E402
from dialtide.llm.importance import importance_resample  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    found = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    return sorted(tuple(r) for r in found)


def as_docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def plain_audit(rows, least, top):
    texts = [(i, *[x or "" for x in r[1:]]) for i, r in enumerate(rows)]
    holders, counts = defaultdict(set), defaultdict(Counter)
    groups = {(lang, source) for _, _, lang, source in texts}
    for i, text, lang, source in texts:
        for term in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text):
            term = term.translate(LOWER)
            holders[lang, term].add(i)
            counts[lang, source][term] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = {t for (x, t), docs in holders.items() if x == lang and len(docs) >= least}
        sources = [s for x, s in groups if x == lang]
        whole = Counter()
        for s in sources:
            whole.update({t: n for t, n in counts[lang, s].items() if t in kept})

        def shares(count):
            total = sum(n for t, n in count.items() if t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, k) for k, (t, v) in enumerate(items[:limit], 1)]
    return sorted(out)


@pytest.mark.parametrize(("least", "top"), [(3, 200), (1, 5), (2, 7), (5, 40)])
def test_source_audit_is_exact(spark, rows, least, top, monkeypatch):
    monkeypatch.setattr(source_audit, "BLOCK_CELLS", 1 << 8)
    odd = [(None, None, None, None), (1, "", "en", None), (1, "", "en", None), (2, "A,a a-A Ünï x", None, "s"), (3, "\x00\t 12 !", "xx", "t")]
    several = [(900 + i, w, "zz", "q") for i, w in enumerate(["one. One", "one", "one,", "two two", "two;", "six six. six,", "six", "six!", "six?"])]
    given = rows[:80] + odd + several
    found = source_audit.source_audit(as_docs(spark, given), least, top).collect()
    assert sorted(map(tuple, found)) == plain_audit(given, least, top)


def test_source_audit_with_many_sources(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "BLOCK_SOURCES", 4)
    rnd = random.Random(5)
    given = [(i, " ".join(rnd.choice("abcdefghij") * rnd.randint(1, 2) for _ in range(30)), "en", f"s{i % 11}") for i in range(60)]
    found = source_audit.source_audit(as_docs(spark, given)).collect()
    assert sorted(map(tuple, found)) == plain_audit(given, 3, 200)


def test_source_audit_counts_chunks_of_few_groups_in_a_task(spark):
    from pyspark.sql import functions as F

    given = [(i, f"a b{i % 5}", ("de", "en")[i % 2], f"s{i % 8}") for i in range(800)] + [(800 + i, "x", "en", "large") for i in range(800)]
    docs = as_docs(spark, given).withColumn("row", F.monotonically_increasing_id())
    found = source_audit.by_group(docs.repartition(8, "row")).groupBy(F.spark_partition_id().alias("task"))
    tasks = found.agg(F.count_distinct("lang", "source").alias("groups"), F.count_if(F.col("source") == "large").alias("large")).collect()
    assert sum(t["groups"] for t in tasks) < 9 + len(tasks)  # 9 each where they lie
    assert len(tasks) == 1 or max(t["large"] for t in tasks) < 800


def test_source_audit_cuts_chunks_at_white_space_of_ascii(spark):
    import pyarrow as pa

    texts = ["", " \t", "a\x0bb\x0cc\rd\ne f", "a\x1cb\x1fc d\x85e f\u00a0g\u2003h \x00 \x00", " a a  ünï ", "a", "ünï a"]
    langs, sources, ids = ["l", "l", "m", "l", "l", "m", "l"], ["s", "t", "s", "t", "s", "s", "s"], [9, 8, 3, 7, 6, 1, 2]
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": langs, "source": sources, "row": ids})
    found = [tuple(r.values()) for b in source_audit._chunk_counts(iter([batch])) for r in b.to_pylist()]
    wanted = defaultdict(list)
    for text, lang, source, row in zip(texts, langs, sources, ids):
        for chunk in text.encode().split():
            wanted[lang, source, chunk.decode()].append(row)
    assert sorted(found) == sorted((*k, len(v), len(set(v)), min(v), max(v)) for k, v in wanted.items())


def test_share_is_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    n, total = 9 * 10**17, 4 * 10**18
    got = spark.range(1).select(source_audit.share(F.lit(n), F.lit(total), F.lit(7)).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (n + 1) // (total + 7)


def plain_importance(rows, target, runs=1, seed=2024):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))

    def buckets(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in range(1, runs + 1) for i in range(len(w) - k + 1)]

    own, aim = Counter(b for r in rows for b in buckets(r[1])), Counter(b for t in target for b in buckets(t))
    s, t = sum(own.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (s + 10_000) / ((own[b] + 1) * (t + 10_000))))
    out = []
    for doc_id, text, *_ in rows:
        found = buckets(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(words(text)), len(found), weight, score))
    ranked = sorted((x for x in out if x[1] >= 20), key=lambda x: (-x[4], x[0] is None, x[0]))
    drawn = ranked[: 10 * len(ranked) // 100]
    left = list(out)
    result = []
    for place, x in enumerate(drawn, 1):
        left.remove(x)
        result.append((*x, place))
    return sorted(result + [(*x, None) for x in left], key=str)


@pytest.mark.parametrize(("runs", "head"), [(1, 1 << 16), (1, 50), (2, 1 << 16), (2, 40), (3, 100)])
def test_importance_is_exact_whatever_the_head(spark, rows, runs, head):
    odd = [(None, None, "en", "s")] + [(None, rows[0][1], "en", "s")] * 12 + [(5000, "", "en", "s"), (5001, "É É\x00é Z" * 9000, "en", "s")]
    given = rows[:120] + odd
    target = [r[1] for r in rows[3:9]] + ["", None]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance_resample(as_docs(spark, given), aim, max_run=runs, head=head).collect()
    assert sorted(map(tuple, found), key=str) == plain_importance(given, target, runs)


def test_importance_of_empty_tables(spark, rows):
    docs, none = as_docs(spark, rows[:30]), as_docs(spark, [])
    assert importance_resample(none, docs).count() == 0
    found = importance_resample(docs, none).collect()
    assert sorted(map(tuple, found), key=str) == plain_importance(rows[:30], [])


def test_head_and_tail_give_one_bucket():
    words = [w.encode() for w in "the of a é x the of".split()]
    states = {w: zlib.crc32(w) for w in (b"the", b"of")}
    pairs = {(b"the", b"of"): zlib.crc32(b"the of")}
    for run in (1, 2, 3, 4):
        plain = [zlib.crc32(b" ".join(words[i : i + k])) % 10_000 for k in range(1, run + 1) for i in range(len(words) - k + 1)]
        assert importance.feature_buckets(words, run, (states, pairs)) == plain
        assert importance.feature_buckets(words, run, ({}, {})) == plain


def plain_fingerprint(text):
    """Place by place, with the random bits themselves."""
    e = edit_fingerprints
    mix = lambda x: int(e.mix(np.array([x % 2**64], np.uint64))[0])
    bits = (e._random(1, e.WALKS * e.CLASSES * e.PERIOD) >> np.uint64(63)).reshape(e.WALKS, e.CLASSES, e.PERIOD)
    out = bytearray()
    for walk in range(e.WALKS):
        at, embedded = 0, []
        classes = [mix(ord(c) + 77) % e.CLASSES for c in text]
        while at < len(text):
            embedded.append(ord(text[at]))
            at += int(bits[walk, classes[at], (len(embedded) - 1) % e.PERIOD])
        salts = e._random(7 + walk, e.SAMPLES).tolist()
        for s in range(e.SAMPLES):
            inside = [p for p in e.places(walk * e.SAMPLES + s).tolist() if p < len(embedded)]
            out.append(mix(embedded[inside[-1]] + mix(inside[-1] + salts[s])) >> 56 if inside else 0)
    return bytes(out).hex()


def plain_neighbours(rows):
    order = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    following = {x: order[(i + 1) % len(order)][2] for i, x in enumerate(order)}
    alike = lambda a, b: sum(a[i : i + 2] == b[i : i + 2] for i in range(0, len(a), 2)) / (len(a) // 2)
    out = []
    for r in rows:
        text = r[1] or ""
        after = following[r[0] is None, r[0] or 0, text]
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        a, b, c = map(plain_fingerprint, (text, new, after))
        out.append((r[0], len(text), hashlib.sha256(new.encode()).hexdigest(), a, b, alike(a, b), alike(a, c)))
    return sorted(out, key=str)


def test_fingerprints_of_neighbours(spark, rows):
    short = [(r[0], r[1][:400]) for r in rows[:70]]
    odd = [(None, None), (1000, ""), (1001, "x"), (1002, "ab"), (1003, "\U0001f600é" * 30), (1001, "x"), (1004, "a" * 3000)]
    given = [(*r, "en", "s") for r in short + odd]
    found = document_fingerprints(as_docs(spark, given)).collect()
    assert sorted(map(tuple, found), key=str) == plain_neighbours(given)


def test_fingerprints_with_a_hot_id_and_without_ids(spark):
    given = [(7, f"text number {i}", "en", "s") for i in range(300)] + [(None, f"other {i}", "en", "s") for i in range(300)]
    given += [(i, f"one more {i}", "en", "s") for i in range(20)]
    df = as_docs(spark, given)
    found = document_fingerprints(df).collect()
    hashes = {(r[0], r[1]): r[2] for r in df.selectExpr("doc_id", "text", "xxhash64(text)").collect()}
    order = sorted(hashes, key=lambda k: (k[0] is None, k[0] or 0, hashes[k]))
    changed = sorted(edit_fingerprints.edited(a[1], b[1]) for a, b in zip(order, order[1:] + order[:1]))
    assert sorted(r["edited_sha256"] for r in found) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in changed)


def test_one_document_follows_itself_and_empty_tables(spark):
    (row,) = document_fingerprints(as_docs(spark, [(4, "abcd", "en", "s")] * 1)).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1
    twice = document_fingerprints(as_docs(spark, [(4, "abcd", "en", "s")] * 2)).collect()
    assert twice == [row, row]
    assert document_fingerprints(as_docs(spark, [])).count() == 0


def test_few_edits_leave_fingerprints_alike(rows):
    rnd = random.Random(3)
    texts = [r[1] for r in rows if 500 < len(r[1]) < 8000][:100]

    def changed(text):
        at = rnd.randrange(len(text))
        return text[:at] + rnd.choice("xyz") + text[at + 1 :]

    a, b = (edit_fingerprints.fingerprint_texts(x) for x in (texts, [changed(t) for t in texts]))
    near, far = (a == b).mean(axis=1), (a == np.roll(a, 1, 0)).mean(axis=1)
    assert np.median(near) > 0.9 and far.max() < 0.3


def test_classes_of_alike_fingerprints(spark, rows):
    rnd = random.Random(11)
    texts = [r[1][:1500] for r in rows if len(r[1]) > 600][:60]
    for t in texts[:25]:
        at = rnd.randrange(len(t))
        texts.append(t[:at] + "#" + t[at + 1 :])
    texts += [texts[0], "", None, ""]
    found = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in edit_fingerprints.edit_classes(as_docs(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()}
    prints = edit_fingerprints.fingerprint_texts([t or "" for t in texts])
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if 10 * (prints[a] == prints[b]).sum() >= 8 * prints.shape[1]:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    want = [root(i) for i in range(len(texts))]
    got = [found[i][0] for i in range(len(texts))]
    assert len(set(want)) < len(texts) - 15
    assert sum(x == y for x, y in zip(got, want)) >= 0.95 * len(want)  # a band may be missed at the limit
    assert all(want[c] == want[i] for i, c in enumerate(got)) and Counter(got)[got[-1]] == found[len(texts) - 1][1] == 3


@pytest.mark.parametrize("lanes", [1, 1 << 20])
def test_walks_together_and_alone_agree(rows, lanes, monkeypatch):
    texts = ["", *[r[1] for r in rows[:40]], "z"]
    plain = edit_fingerprints.fingerprint_texts(texts)
    monkeypatch.setattr(edit_fingerprints, "FEW_LANES", lanes)
    assert (edit_fingerprints.fingerprint_texts(texts) == plain).all()


def test_clashing_columns_and_empty_tables(odd_documents, spark):
    aim = spark.createDataFrame([("one two",)], "text string")
    for run in (source_audit.source_audit, lambda d: importance_resample(d, aim), document_fingerprints, edit_fingerprints.edit_classes):
        assert run(odd_documents).count() >= 0
        assert run(odd_documents.limit(0)).count() == 0


def test_ids_decode_from_bytes_as_the_library_decodes_them():
    import numpy as np

    from dialtide.llm.tokens import default_path, encoder

    own, rnd = encoder(default_path("byte_bpe_50k.json")), np.random.default_rng(6)
    specials = [i for i, t in own.tokenizer.get_added_tokens_decoder().items()]
    for _ in range(50):  # most of these bytes are no text
        ids = [rnd.integers(0, own.size, n).astype("<u4") for n in (0, 3, 40)] + [np.array(specials, "<u4")]
        assert own.decode(ids).to_pylist() == own.tokenizer.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)
    texts = ["", "naïve\x00 日本 🙂\n", "a" * 70_000, "<|endoftext|> x"]
    ids = [np.array(own.library_ids(t), "<u4") for t in texts]
    assert own.decode(ids).to_pylist() == texts
