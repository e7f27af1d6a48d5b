"""Operators on documents, against plain versions and on odd inputs."""

import hashlib
import os
import random
import sys
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from dialtide.llm import bpe_tree, compression_classifier, exact_dedup, line_dedup, minhash, packing  # noqa: E402
from dialtide.llm import quality_rules, suffix_dedup, token_files  # noqa: E402
from dialtide.session import scratch_dir  # noqa: E402


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def small(spark, sf_dir):
    """The documents table and its rows in order of their ids."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df, sorted((r["doc_id"], r["text"], r["source"]) for r in df.collect())


OPERATORS = {
    "exact": exact_dedup.exact_dedup,
    "lines": line_dedup.line_dedup,
    "quality": quality_rules.quality_rules,
    "quality_filter": quality_rules.quality_filter,
    "suffix": suffix_dedup.suffix_dedup,
    "near": minhash.near_duplicates,
    "near_filter": minhash.near_filter,
    "pack": packing.pack,
    "files": token_files.token_files,
    "bpe": bpe_tree.bpe_round_trip,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_give_empty_results(odd_documents, name):
    assert OPERATORS[name](odd_documents.limit(0)).count() == 0


def test_exact_dedup_on_odd_rows(odd_documents):
    rows = exact_dedup.exact_dedup(odd_documents, block_chars=64).collect()
    assert len(rows) == odd_documents.count()
    by_sha = defaultdict(list)
    for r in rows:
        by_sha[r["text_sha256"]].append(r)
    assert all(sum(r["kept"] for r in group) == 1 for group in by_sha.values())
    assert all(r["group_size"] == len(group) for group in by_sha.values() for r in group)
    texts = [r["text"] for r in odd_documents.select("text").collect()]
    assert set(by_sha) == {brute.sha(brute.normalised(t)) for t in texts}
    blank = by_sha[brute.sha("")]
    assert sorted(str(r["doc_id"]) for r in blank) == ["1", "None", "None"] and {r["keep_id"] for r in blank} == {1}


def test_exact_dedup_survives_colliding_keys(documents):
    texts = ["ab" * 40, "ba" * 40, "ab" * 40, "", "ab" * 39 + "ba"]
    weak = lambda block, seed: exact_dedup.block_key(block if seed else F.length(block).cast("string"), seed)
    rows = exact_dedup.exact_dedup(documents(list(enumerate(texts))), 16, weak).collect()
    assert {r["doc_id"]: r["keep_id"] for r in rows} == {0: 0, 1: 1, 2: 0, 3: 3, 4: 4}


def test_line_dedup(documents):
    rng = random.Random(5)
    texts = ["\n".join(rng.choice([" Menu\t", "menu", "x", "", "Keep me", "é" * 3]) + rng.choice(["", "", str(i)]) for _ in range(6)) for i in range(60)]
    texts += [None, "", "\n", "menu\n\n"]
    df = documents(list(enumerate(texts)) + [(None, "menu\nrest"), (None, "menu\nrest")])
    want = brute.lines_kept(texts + ["menu\nrest"] * 2)
    got = line_dedup.line_dedup(df)
    assert table(got, "doc_id", "text") == sorted(zip([*range(len(texts)), None, None], want), key=str)
    counts = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in got.collect()}
    assert counts[60] == (1, 0) and counts[62] == (2, 0)
    assert got.columns[:5] == df.columns


def test_quality_rules_match_the_plain_version(small, odd_documents):
    df, rows = small
    got = sorted(quality_rules.quality_rules(df).collect())
    assert [tuple(r)[1:7] for r in got] == [brute.quality_figures(t) for _, t, _ in rows]
    assert [r["kept"] for r in got] == brute.quality_kept([(t, s) for _, t, s in rows])
    assert quality_rules.quality_filter(df).count() == sum(r["kept"] for r in got)
    figures = {str(r["doc_id"]): tuple(r)[1:7] for r in quality_rules.quality_rules(odd_documents).collect()}
    texts = {str(r["doc_id"]): r["text"] for r in odd_documents.collect()}
    assert all(figures[i] == brute.quality_figures(texts[i]) for i in texts if i != "None")


def test_template_lines_reject_depleted_documents_but_not_copies(documents):
    menu = "home about contact shop basket account help news jobs press " * 3
    rows = [(i, f"{menu}\nword{i} only", "site") for i in range(30)]
    rows += [(100 + i, f"{menu}\n" + " ".join(f"own{i}w{j}" for j in range(300)), "site") for i in range(5)]
    rows += [(200 + i, " ".join(f"copied{j}" for j in range(50)), "other") for i in range(40)]
    rows += [(300 + i, " ".join(f"none{j}" for j in range(50)), None) for i in range(3)]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(documents(rows)).collect()}
    assert kept == {i: ok for (i, _, _), ok in zip(rows, brute.quality_kept([r[1:] for r in rows]))}
    assert not any(kept[i] for i in range(30)) and all(kept[i] for i in kept if i >= 100)
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in quality_rules.quality_filter(documents(rows)).collect()}
    assert texts == {i: (t, len(t)) for (i, _, _), (ok, t) in zip(rows, brute.quality_judged([r[1:] for r in rows])) if ok}
    assert all(menu not in t for t, _ in texts.values())


def test_the_limit_of_template_lines_grows_slower_than_the_host(documents):
    """The same line in the same number of documents, of a host of 100 and one of 400."""
    line = "the footer of the site"
    rows = [(i, (f"{line}\n" if i % 100 < 12 else "") + " ".join(f"{i}w{j}" for j in range(30)), "small" if i < 100 else "large") for i in range(500)]
    rows = [(i, t if h == "small" or i < 112 else t.replace(f"{line}\n", ""), h) for i, t, h in rows]
    got = {r["doc_id"]: r["n_template_lines"] for r in quality_rules.quality_rules(documents(rows)).collect()}
    assert sorted(i for i, n in got.items() if n) == list(range(12))
    assert sum(got.values()) == 12  # 12 * 12 >= 100, and < 400


@pytest.mark.parametrize("large_bucket", [2000, 2])
def test_suffix_dedup(documents, large_bucket):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    texts = []
    for i in range(60):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(2)]
        cut = passage[rng.randint(0, 60) : rng.randint(80, len(passage))]
        texts.append(parts[0] + (cut if i % 3 else "") + parts[1])
    texts += [None, "", "x" * 30, "x" * 30, texts[3], "ab" * 100, "short", passage * 3]
    df = documents(list(enumerate(texts)))
    for length in (20, 33):
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.suffix_dedup(df, length, large_bucket).collect()}
        assert [got[i] for i in range(len(texts))] == brute.repeats_removed(texts, length)


def test_suffix_dedup_of_long_texts_goes_stretch_by_stretch(documents, monkeypatch):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh") for _ in range(9000))
    texts = [base, base[2000:5000] + "".join(rng.choice("ABCD") for _ in range(3000)), "".join(rng.choice("wxyz") for _ in range(6000))]
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 1000)
    run = suffix_dedup._anchored({suffix_dedup.BYTES: 400})
    import pyarrow as pa

    whole = pa.RecordBatch.from_arrays([pa.array([0] * 3), pa.array([0] * 3), pa.array(texts)], names=["k1", "k2", "text"])
    anchors = {(i, a) for i, row in enumerate(next(run([whole])).to_pylist()) for a in row["at"]}
    monkeypatch.undo()
    expected = {(i, a) for i, row in enumerate(next(suffix_dedup._anchored({suffix_dedup.BYTES: 400})([whole])).to_pylist()) for a in row["at"]}
    assert anchors == expected
    got = suffix_dedup.suffix_dedup(documents(list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [bytes(r["kept"]) for r in got] == [x[3] for x in brute.repeats_removed(texts, 400)]


@pytest.mark.parametrize(("words", "large_bucket"), [(5, 2000), (8, 2), (51, 2)])
def test_repeated_passages(documents, words, large_bucket):
    rng = random.Random(words)
    own = [f"{rng.choice('abcdé')}{i}" for i in range(300)]
    passage = [rng.choice(own) for _ in range(words * 3)]
    texts = []
    for i in range(40):
        cut = passage[rng.randrange(words) : rng.randrange(words, words * 3)]
        space = rng.choice([" ", "  ", "\n", "\t "])
        parts = [" ".join(f"{i}x{rng.randrange(9)}" for _ in range(rng.randint(0, words))) for _ in range(2)]
        texts.append(space.join([parts[0], space.join(cut if i % 3 else cut[: words - 1]), parts[1]]))
    texts += [None, "", " ", " ".join(["y"] * (words + 3)), " ".join(passage) * 2, texts[1], " ".join(own[:words])]
    df = documents(list(enumerate(texts)))
    got = {r["doc_id"]: (r["n_passages"], r["n_passage_words"]) for r in suffix_dedup.suffix_dedup(df, 400, large_bucket, words).collect()}
    kept = dict(suffix_dedup.passage_filter(df, words, large_bucket).select("doc_id", "text").collect())
    plain = brute.passages_removed(texts, words)
    assert [(*got[i], kept[i]) for i in range(len(texts))] == plain
    assert sum(1 for p in plain if p[0]) > 15 and any(not p[0] for p in plain[:40])


def test_adjoining_short_repeats_are_no_passage(documents):
    own = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    short = [own(c, 20) for c in "abc"]
    texts = [" ".join(short), *[f"{own(f'v{i}.', 30)} {s} {own(f'w{i}.', 30)}" for i, s in enumerate(short)]]
    df = documents(list(enumerate(texts)))
    assert dict(suffix_dedup.passage_filter(df).select("doc_id", "text").collect()) == dict(enumerate(texts))
    assert {r["n_passages"] for r in suffix_dedup.suffix_dedup(df).collect()} == {0}


def test_long_texts_have_their_passages_stretch_by_stretch(monkeypatch):
    import pyarrow as pa

    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(9000)), "short text"]
    batch = pa.RecordBatch.from_arrays([pa.array([0] * 2), pa.array([0] * 2), pa.array(texts)], names=["k1", "k2", "text"])
    find = lambda: {(i, a) for i, row in enumerate(next(suffix_dedup._anchored({suffix_dedup.WORDS: 51})([batch])).to_pylist()) for a in row["at"]}
    whole = find()
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 1000)
    assert find() == whole and len(whole) > 100


def test_near_duplicates_match_all_pairs(small, spark):
    df, rows = small
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(df).collect()}
    classes = brute.near_classes([t for _, t, _ in rows])
    assert got == {rows[i][0]: rows[c][0] for i, c in enumerate(classes)}


def test_near_duplicates_join_groups_through_their_members(documents):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(5000)]

    def edited(text, n):
        text = list(text)
        for _ in range(n):
            text[rng.randrange(len(text))] = rng.choice(words)
        return text

    chain = [[rng.choice(words) for _ in range(300)]]
    for _ in range(30):
        chain.append(edited(chain[-1], 4))
    shared = [rng.choice(words) for _ in range(60)]
    mixed = [shared + [rng.choice(words) for _ in range(20)] for _ in range(40)]
    texts = [" ".join(t) for t in chain + mixed] + ["", None, " ", "a b", "A  b", "a b c"]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(documents(list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == brute.near_classes(texts)


def test_near_duplicates_with_unequal_counts(documents):
    rng = random.Random(2)
    texts = []
    for i in range(8):
        # the same shingles, some of them repeated in one text only; a phrase that starts over makes no new ones after the first
        words = [f"w{i}.{j}" for j in range(100)]
        phrase = [f"p{i}.{j}" for j in range(30)]
        texts += [" ".join(words + phrase * 2), " ".join(words + phrase * 100)]
    for i in range(8):
        words = [f"v{i}.{j}" for j in range(160)]
        extra = [f"x{i}.{j}" for j in range(24)]
        texts += [" ".join(words), " ".join(words + extra * 50)]
    rng.shuffle(texts)
    expected = brute.near_classes(texts)
    assert len(set(expected)) == 16
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(documents(list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == expected


def test_weighted_near_duplicates(documents):
    rng = random.Random(6)
    texts = []
    for i in range(12):
        # near as sets; the repeats of some shingles set the weighted ones apart
        words, phrase = [f"w{i}.{j}" for j in range(60)], [f"p{i}.{j}" for j in range(40)]
        texts += [" ".join(words + phrase * 2), " ".join(words + phrase * rng.choice([2, 3, 60]))]
    df = documents(list(enumerate(texts)))
    for repeats in (False, True):
        got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(df, repeats).collect()}
        assert [got[i] for i in range(len(texts))] == brute.near_classes(texts, repeats)
    assert len(set(brute.near_classes(texts, True))) > len(set(brute.near_classes(texts))) == 12


def test_buckets_with_many_classes_lose_no_link(spark):
    """Classes that similar members of any bucket join are joined, whatever the size of the blocks, with few links."""
    rng = np.random.default_rng(3)
    base = [rng.choice(2**40, 300, replace=False).astype(np.uint64) for _ in range(6)]
    sets, owner, hashes = [], [], []
    for i in range(150):
        own = base[i % 6].copy()
        change = rng.random(300) < rng.choice([0.01, 0.06, 0.2])
        own[change] = rng.integers(2**41, 2**42, change.sum())
        own = np.unique(own)
        sets.append(own)
        owner += [i] * len(own)
        hashes.append(own)
    from dialtide.llm.shingles import mix, prob_minhash

    signature = prob_minhash(np.array(owner), np.concatenate(hashes), np.ones(len(owner)), 150, minhash.COMPONENTS)
    sig = (mix(signature) >> np.uint64(56)).astype(np.uint8)
    nodes = spark.createDataFrame([(i, sig[i].tobytes()) for i in range(150)], "node long, sig binary")
    stored = spark.createDataFrame([(i, s.tobytes(), b"") for i, s in enumerate(sets)], "node long, hashes binary, weights binary")
    cells = [(b, sig[i, 8 * b : 8 * b + 8].tobytes(), i) for i in range(150) for b in range(minhash.BANDS)]
    number = {k: n for n, k in enumerate(sorted({c[:2] for c in cells}))}
    members = spark.createDataFrame([(number[c[:2]], c[0], c[2]) for c in cells], "key long, band int, node long")
    start = {i: (i if i < 100 else 100 + i % 6) for i in range(150)}
    labels = spark.createDataFrame([(i, v) for i, v in start.items() if v != i], "node long, label long")
    buckets = defaultdict(set)
    for b, key, i in cells:
        buckets[b, key].add(i)
    near = {(a, b) for own in buckets.values() for a in own for b in own if a < b
            and 10 * len(np.intersect1d(sets[a], sets[b])) >= 8 * len(np.union1d(sets[a], sets[b]))}

    def classes(links):
        parent = {v: v for v in start.values()}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            x, y = root(start[a]), root(start[b])
            parent[max(x, y)] = min(x, y)
        return [root(start[i]) for i in range(150)]

    want = classes(near)
    assert 6 <= len(set(want)) < 80
    for block in (7, 512):
        got = [tuple(r) for r in minhash.between_classes(members, labels, nodes, stored, block).collect()]
        assert classes(got) == want
        assert all(tuple(sorted(g)) in near for g in got)
        assert block < 512 or len(got) < len(near) / 2


def test_recall_against_all_pairs(documents):
    rng = random.Random(8)
    words, texts = [f"w{i}" for i in range(3000)], []
    for _ in range(80):
        text = [rng.choice(words) for _ in range(200)]
        texts.append(" ".join(text))
        for at in rng.sample(range(200), 3 + rng.randrange(2)):
            text[at] = "edited"
        texts.append(" ".join(text))
    want = brute.near_classes(texts)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(documents(list(enumerate(texts)))).collect()}
    pairs = [i for i, c in enumerate(want) if c != i]
    found = [i for i in pairs if got[i] == want[i]]
    assert len(pairs) > 30 and len(found) >= 0.9 * len(pairs)
    assert all(want[got[i]] == want[i] for i in got)  # none is joined that is not similar


def test_near_filter_keeps_one_row_a_class(odd_documents):
    classes = minhash.near_duplicates(odd_documents).collect()
    kept = minhash.near_filter(odd_documents)
    assert kept.columns == odd_documents.columns and len(classes) == odd_documents.count()
    assert kept.count() == sum(r["kept"] for r in classes) == len({r["class_id"] for r in classes})


def test_prob_minhash_estimates_probability_jaccard():
    from dialtide.llm.shingles import mix, prob_minhash

    h = mix(np.arange(1, 61, dtype=np.uint64))
    a, b = np.r_[0:50], np.r_[10:60]
    wa, wb = 1 + np.arange(50) % 3, 1 + np.arange(50) % 5 / 2
    owner = np.r_[np.zeros(50, int), np.ones(50, int)]
    s = prob_minhash(owner, np.r_[h[a], h[b]], np.r_[wa, wb].astype(float), 2, 4096)
    x, y = np.zeros(60), np.zeros(60)
    x[a], y[b] = wa, wb
    both = [i for i in range(60) if x[i] and y[i]]
    want = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in both)
    assert abs((s[0] == s[1]).mean() - want) < 0.03


def check_pieces(rows, ids, length):
    """Pieces cover every document once, sequences have no holes and need no padding."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(own) == r["length"] > 0
        documents[r["doc_id"]].append((r["start"], own, r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: sum((x for _, x, _ in sorted(v)), []) for k, v in documents.items()} == ids
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length and at & (at - 1) == 0


def test_packing(small, documents):
    df, rows = small
    ids = {i: brute.encoded("word_bpe_49k.json", t, (2,)) for i, t, _ in rows}
    check_pieces(packing.pack(df).collect(), ids, 4096)
    check_pieces(packing.pack(df, sequence_tokens=64, class_tokens=4).collect(), ids, 64)
    texts = ["a " * n for n in (0, 1, 31, 32, 33, 500)] + [None]
    ids = {i: brute.encoded("word_bpe_49k.json", t, (2,)) for i, t in enumerate(texts)}
    check_pieces(packing.pack(documents(list(enumerate(texts))), sequence_tokens=32, class_tokens=2).collect(), ids, 32)


def test_column_generation_comes_close_to_the_bound():
    rng = np.random.default_rng(4)
    sizes, demand = np.arange(3, 33), rng.integers(50, 400, 30).astype(float)
    patterns = packing.solve_patterns(sizes, demand, 64)
    made = sum(p * v for p, v in patterns)
    assert all((p * sizes).sum() <= 64 for p, _ in patterns)
    assert sum(v for _, v in patterns) <= 1.02 * (demand * sizes).sum() / 64 + len(sizes)
    assert (np.minimum(made, demand) * sizes).sum() > 0.95 * (demand * sizes).sum()


def test_token_files(spark, small, documents, tmp_path):
    df, rows = small
    start, want = 0, []
    for i, t, _ in rows:
        own = brute.encoded("word_bpe_49k.json", t, (2,))
        want.append((i, start, len(own), np.asarray(own, "<u4").tobytes()))
        start += len(own)
    folder = scratch_dir(spark, "files")
    manifest = token_files.write_token_files(df, folder, sequence_tokens=64, file_tokens=5000)
    got = token_files.read_documents(manifest, folder).collect()
    assert sorted((r[0], r[1], r[2], bytes(r[3])) for r in got) == want
    first = manifest.orderBy("part", "file").first()
    fs, _ = token_files.filesystem(folder)
    file = token_files.TokenFile(fs, first["tokens_path"])
    ids, mask = file.sequence(0)
    assert len(ids) == 64 and mask.all() and ids.base is not None  # a view, not a copy
    ids, mask = file.sequence((first["n_tokens"] - 1) // 64)
    assert mask.sum() == (first["n_tokens"] - 1) % 64 + 1 and not ids[~mask].any()


def test_token_files_of_odd_rows(odd_documents):
    rows = token_files.token_files(odd_documents).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None] * 3 + [1, 2, 3, 3, 4, 5, 6, 7, 8, 9, 10]
    assert rows[-1]["start"] == sum(r["n_tokens"] for r in rows[:-1])


@pytest.mark.parametrize("piece", [7, 50, 32_768])
def test_bpe_of_whole_texts(documents, odd_documents, piece):
    rng = random.Random(piece)
    atoms = ["the", " ", "  ", "\n", "'s", "it'", "naïve", "漢字", "123", "4", "!!", "<|endoftext|>", "\t", "é", "\U0001f600", "x" * 30, "aaaa", ".", " ", "́", "ﬁ"]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += ["a" * 3000, " " * 500, "ab" * 700, "é" * 900, None, ""]
    library = brute.library("byte_bpe_50k.json")
    got = {r["doc_id"]: r for r in bpe_tree.bpe_round_trip(documents(list(enumerate(texts))), piece_chars=piece).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(got[i]["ids"]), "<u4").tolist() == ids, t
        assert got[i]["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe_tree.bpe_round_trip(odd_documents).count() == odd_documents.count()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_part_encoder_agrees_with_the_library(name):
    from dialtide.llm.tokens import PartEncoder, default_path

    own, library, rng = PartEncoder(default_path(name)), brute.library(name), random.Random(2)
    assert own.style in ("drop", "lead")
    atoms = ["The", "ÀÉß", " ", "  ", "\n", "\r\n", "don't", "İ", "Σίσυφος", "ΑΣ", "é", "12", ".", ",", "...", "<|startoftext|>", "<|endoftext|>", " ", "\x1c", "ǅ", "ﬀ", "µ", "ª"]
    for _ in range(1500):
        text = "".join(rng.choice(atoms) + rng.choice(["", " "]) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(own.encode(text), own.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_classifier_separates_held_out_labels(spark, odd_documents):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = compression_classifier.compression_classifier(docs, labels)
    assert got.count() == docs.count()
    held = got.filter("held_out").join(labels, "doc_id").collect()
    import zlib

    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in held)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    flipped = labels.withColumn("quality", F.when(compression_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = compression_classifier.compression_classifier(docs, flipped)
    assert table(again, "doc_id", "score") == table(got, "doc_id", "score")  # held-out labels change nothing


def test_classifier_scores_are_the_plain_ones(small, spark, sf_dir, documents):
    """The sizes with either dictionary, block by block, and the logistic formula, recomputed one text at a time."""
    import math

    import zstandard

    docs, rows = small
    model = compression_classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    texts = [*[t for _, t, _ in rows[:80]], "", None, " ".join(t for _, t, _ in rows[:60])]

    def size(text, content):
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data = text.encode()
        parts = [data[i : i + 16384] for i in range(0, len(data), 16384)] or [b""]
        return sum(len(zstandard.ZstdCompressor(level=9, dict_data=held).compress(p)) for p in parts)

    def plain(text):
        n = len(text.encode())
        difference, length = (size(text, model.bad) - size(text, model.good)) / max(n, 1), math.log(1 + min(n, 16384))
        one, a, b, c = model.weights
        return 1 / (1 + math.exp(-(one + a * difference + b * length + c * difference * length)))

    got = compression_classifier.score(documents(list(enumerate(texts))), model).collect()
    for r in got:
        want = plain(texts[r["doc_id"]] or "")
        assert abs(r["score"] - want) < 1e-9 and r["predicted"] == int(want >= 0.7)
    assert len(got) == len(texts) and len({r["predicted"] for r in got}) == 2


def test_classifier_counts_every_part_of_long_texts(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = compression_classifier.fit(docs, labels)
    rows = docs.join(labels, "doc_id").filter(compression_classifier.held_out(F.col("doc_id"))).orderBy("doc_id").collect()
    texts, expected = [], []
    for label in (0, 1):
        joined = "\n".join(r["text"] for r in rows if r["quality"] == label and r["text"])
        for size in (100_000, 1_000_000, 3_000_000):
            texts.append((joined * (size // len(joined) + 1))[:size])
            expected.append(label)
    got = compression_classifier.score(documents(list(enumerate(texts))), model).collect()
    assert [r["predicted"] for r in sorted(got, key=lambda r: r["doc_id"])] == expected


def test_classifier_without_labels(odd_documents, spark):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (3, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    rows = compression_classifier.compression_classifier(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count() and {r["score"] for r in rows} == {0.5} and {r["predicted"] for r in rows} == {0}


def test_hashes_are_those_of_the_contract(small):
    df, rows = small
    got = {r["doc_id"]: r["text_sha256"] for r in exact_dedup.exact_dedup(df).collect()}
    assert got == {i: hashlib.sha256(brute.normalised(t).encode()).hexdigest() for i, t, _ in rows}
