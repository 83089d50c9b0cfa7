"""Operators on texts against brute force and round trips, with the defined edge cases."""
import collections
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from geopulse.llm import (
    dart_minhash, phrase_fingerprint, piece_bpe, quality_qda, suffix_decontam, suffix_merge, suffix_tree_lm)
from geopulse.llm.common import utf8
from geopulse.llm.queries import op3_suffix_merge

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.collect()}


# ---- 1: pieces

def test_pieces_equal_the_library(texts, odd_texts):
    library, own = sentencepiece.SentencePieceProcessor(model_file=PATH), piece_bpe.model(PATH)
    rng = random.Random(5)
    mixed = ["".join(rng.choice(" ▁ab.\nThe\t1é日😀<>#\x00eintor0") for _ in range(rng.randrange(40))) for _ in range(2000)]
    for t in [*texts.values(), *(t or "" for t in odd_texts), *mixed]:
        ids = library.encode(t)
        assert own.encode(t) == ids
        assert own.decode([*ids, own.end]) == library.decode([*ids, own.end])


def test_any_ids_decode_as_the_library_does():
    library, own = sentencepiece.SentencePieceProcessor(model_file=PATH), piece_bpe.model(PATH)
    rng = random.Random(6)
    for _ in range(3000):
        ids = [rng.randrange(600) for _ in range(rng.randrange(9))]
        assert own.decode(ids) == library.decode(ids), ids


def test_units_learned_together_are_those_learned_alone(monkeypatch):
    """Units share the prefix tables of those before them; a small cache forgets some on the way."""
    import random

    library, own = sentencepiece.SentencePieceProcessor(model_file=PATH), piece_bpe.PieceModel(PATH)
    rng = random.Random(3)
    parts = ["on", "the", "tion", "é", "ing", "zz", "日本", ".", ",", "st", "", "q", "\n", "  "]
    texts = ["".join(rng.choice(parts) + " " * (rng.random() < .4) for _ in range(rng.randrange(80))) for _ in range(300)] + ["", "x" * 700]
    want = [library.encode(t) for t in texts]
    assert own.encode_all(texts) == want
    own.forget()
    monkeypatch.setattr(piece_bpe, "_CACHE_UNITS", 20)
    assert own.encode_all(texts) == want and [own.encode(t) for t in texts] == want


def test_piece_table_of_odd_rows(odd_documents, odd_texts):
    out = piece_bpe.encode_texts(odd_documents, PATH).collect()
    assert len(out) == len(odd_texts) + 1
    assert all(r.piece_ids == [2] and r.decoded_text == "" for r in out if not r.text)
    assert piece_bpe.encode_texts(odd_documents.limit(0), PATH).count() == 0


# ---- 2: near duplicates

def _sets(texts):
    out = {}
    for d, t in texts.items():
        w = t.encode().lower().split()
        out[d] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def _brute_classes(texts):
    sets, label = _sets(texts), {d: d for d in texts}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and
             (texts[a] == texts[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))]
    for _ in texts:
        before = dict(label)
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    return label


def test_near_classes_equal_brute_force(documents, texts):
    got = {r.key: r.near_class for r in dart_minhash.near_duplicates(documents).collect()}
    assert got == _brute_classes(texts)


def test_near_classes_of_a_group_around_the_threshold(spark):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in rng.integers(0, 5000, 150)]
    texts = {}
    for d in range(160):
        words = list(base)
        for at in rng.integers(0, len(words), d % 9):
            words[at] = f"w{rng.integers(0, 5000)}"
        texts[d] = " ".join(words[:150 - 4 * (d % 13)] if d % 3 == 0 else words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    label = _brute_classes(texts)
    assert 5 < len(set(label.values())) < 120
    assert {r.key: r.near_class for r in dart_minhash.near_duplicates(df).collect()} == label


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    element = rng.integers(1, 1 << 62, 60).astype(np.uint64)
    a, b = rng.uniform(0.2, 4, 60), rng.uniform(0.2, 4, 60)
    row = np.repeat([0, 1], 60)
    order = np.argsort(element)
    e = np.concatenate([element[order]] * 2)
    agree = []
    for salt in range(8):
        s = dart_minhash.signatures(row, e ^ np.uint64(salt * 977), np.concatenate([a[order], b[order]]), 2)
        assert (s != 0).all()
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.06


def test_near_classes_of_odd_rows(odd_documents):
    out = dart_minhash.near_duplicates(odd_documents).collect()
    assert len(out) == odd_documents.count()
    assert {r.near_class for r in out if r.key in (6, 7)} == {6}
    assert all(r.near_class == r.key for r in out if r.key in (2, 4, 5, 8, 9))
    assert dart_minhash.near_duplicates(odd_documents.limit(0)).count() == 0


# ---- 3: repeated substrings

def _removed(raws, length):
    count = collections.Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append(gone)
    return out


@pytest.mark.parametrize("merge_bytes", [1 << 20, 600])
def test_repeats_equal_brute_force(spark, merge_bytes):
    """Shared, overlapping, self-overlapping and periodic passages; with the small
    limit large classes are counted by strings."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(2, 6)))
    base = [" ".join(word() for _ in range(60)) for _ in range(4)]
    texts = [base[0], base[0][20:] + base[1], base[1][:90] + base[2], base[2][30:170] + base[3] + base[2][50:150], "ab" * 120, "b" + "ab" * 50,
             base[3][:60], None, "", base[0], base[1][40:140] + base[0][100:180], base[0][90:200]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_merge.remove_repeats(df, length=40, window=16, merge_bytes=merge_bytes).collect()}
    raws = [(t or "").encode() for t in texts]
    for i, (raw, gone) in enumerate(zip(raws, _removed(raws, 40), strict=True)):
        assert bytes(got[i].kept_bytes) == bytes(np.frombuffer(raw, np.uint8)[~gone]), i
        assert sum(s.end - s.start for s in got[i].removed_spans) == gone.sum()


@pytest.mark.parametrize("merge_bytes", [1 << 20, 600])
def test_passages_equal_brute_force(spark, merge_bytes):
    """Repeats of 40 bytes go, those of 31 are told, in one run and with the same result for the former."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(2, 6)))
    base = [" ".join(word() for _ in range(60)) for _ in range(6)]
    short = [b[i:i + n] for b, i, n in zip(base, (0, 40, 80, 120, 10), (25, 28, 30, 36, 60))]
    texts = [*base[:4], *(base[4][20 * i:20 * i + 20] + s + base[5][20 * i:20 * i + 20] for i, s in enumerate(short)), "ab" * 120,
             "b" + "ab" * 17, short[0], short[1], base[0][40:130] + short[2], None, "", base[1], "x" + base[2][:33], "y" + base[2][:33], "y" + base[2][:33]]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, passages string")
    got = {r.doc_id: r for r in suffix_merge.remove_repeats(df, length=40, window=16, merge_bytes=merge_bytes, passage=31).collect()}
    raws = [(t or "").encode() for t in texts]
    for i, (raw, gone, told) in enumerate(zip(raws, _removed(raws, 40), _removed(raws, 31), strict=True)):
        assert bytes(got[i].kept_bytes) == bytes(np.frombuffer(raw, np.uint8)[~gone]), i
        edges = np.flatnonzero(np.diff(np.concatenate([[0], told, [0]])))
        runs = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]
        assert [(p.start, p.end) for p in got[i].passages] == runs, i
        words = [m.span() for m in re.finditer(rb"[^ ]+", raw)]
        assert [p.words for p in got[i].passages] == [sum(a <= x and y <= b for x, y in words) for a, b in runs], i
    assert any(r.passages and not r.removed_spans for r in got.values())
    with pytest.raises(ValueError, match="passage"):
        suffix_merge.remove_repeats(df, length=40, window=16, passage=30)


def test_words_within_are_whole():
    assert suffix_merge.words_within(b" ab c\td\xc3\xa9 ", [(0, 9), (2, 9), (1, 3), (2, 3), (4, 7), (0, 0)]) == [3, 2, 1, 0, 1, 0]


def test_short_passages_are_told_and_stay(spark, tmp_path):
    """A passage of over 50 words in less than 400 bytes repeats across documents: told, not removed."""
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    own = lambda: " ".join(word(7) for _ in range(80))
    passage, few = " ".join(word(5) for _ in range(55)), " ".join(word(9) for _ in range(35))
    assert 280 <= len(passage) < 400 and 280 <= len(few) < 400
    texts = [own(), f"{own()} {passage} {own()}", f"{own()} {passage}", f"{own()} {few}", f"{few} {own()}", None, own()]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in op3_suffix_merge(spark, str(tmp_path)).collect()}
    assert {i for i, r in got.items() if r.repeats_passage} == {1, 2} == {i for i, r in got.items() if r.n_passages == 1}
    assert all(r.n_removed == r.n_spans == 0 and r.kept_sha256 == hashlib.sha256((texts[i] or "").encode()).hexdigest() for i, r in got.items())


def test_merge_never_loses_order():
    rng = random.Random(4)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(rng.randrange(9))) for _ in range(5)]
    merged = list(suffix_merge.merge_runs([suffix_merge.front_coded(r) for r in runs]))
    flat = [s for _, _, s, _ in merged]
    assert flat == sorted(x for r in runs for x in r)
    for a, (_, _, b, shared) in zip(flat, merged[1:]):
        assert shared == suffix_merge.common_length(a, b, 0)


def test_rows_without_keys_or_with_equal_ones_stay_apart(spark):
    """Unique texts beside copies under the same key (none, or one): only the copies go."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    unique = [" ".join(word() for _ in range(20)) for _ in range(6)]
    copy = " ".join(word() for _ in range(20))
    for key in (None, 7):
        rows = [(key, t, 1, "x", 2.0) for t in [*unique, copy, copy]]
        df = spark.createDataFrame(rows, "doc_id long, text string, id int, row string, `spans.a` double")
        out = suffix_merge.remove_repeats(df, length=40, window=16).collect()
        assert sorted(r.kept_bytes.decode() for r in out) == sorted([*unique, "", ""])
        assert all(r.id == 1 and r.row == "x" and r["spans.a"] == 2.0 for r in out)


def test_row_ids_tell_null_from_text(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("null", "a"), ("1", "2:a"), ("12", ":a")], "k string, t string")
    assert df.select(suffix_merge._row_id(F.col("k"), F.col("t")).alias("id")).distinct().count() == 5


def test_repeats_of_odd_rows(odd_documents):
    out = {r.doc_id: r for r in suffix_merge.remove_repeats(odd_documents).collect()}
    assert out[5].kept_bytes == b"" and out[9].kept_bytes == b""  # a period repeats itself
    assert out[0].kept_bytes == b"" and bytes(out[6].kept_bytes) == b"same text here for all of us"
    assert suffix_merge.remove_repeats(odd_documents.limit(0)).count() == 0


# ---- 5: quality

def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    known, other = labels.where("doc_id % 2 = 0"), {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1").collect()}
    scores = {r.key: r.score for r in quality_qda.quality_scores(spark.read.parquet(f"{sf}/documents.parquet"), known).collect()}
    assert np.mean([(scores[d] >= 0.5) == (q == 1) for d, q in other.items()]) > 0.97


def test_quality_of_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 0), (6, 1), (7, None)], "doc_id long, quality int")
    out = quality_qda.quality_scores(odd_documents, labels).collect()
    assert len(out) == odd_documents.count() and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in quality_qda.quality_scores(odd_documents, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in quality_qda.quality_scores(odd_documents, labels.where("quality = 0")).collect()} == {0.0}


# ---- 6: decontamination

def _words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def _brute_matches(docs, items):
    """(words, hit words, hit items, longest match by item) of each text, from all pairs of places."""
    out = []
    for t in docs:
        d, hit, longest = _words(t), set(), {}
        for name, text in items:
            w = _words(text)
            size = min(10, len(w))
            if not w:
                continue
            for p in range(len(d) - size + 1):
                for q in range(len(w) - size + 1):
                    if d[p:p + size] != w[q:q + size]:
                        continue
                    n = size
                    while p + n < len(d) and q + n < len(w) and d[p + n] == w[q + n] and len(w) >= 10:
                        n += 1
                    hit.update(range(p, p + n))
                    if name not in longest or (-n, p, q) < longest[name]:
                        longest[name] = (-n, p, q)
        out.append((len(d), hit, sorted(longest), {k: (p, q, -n) for k, (n, p, q) in longest.items()}))
    return out


@pytest.mark.parametrize("part_bytes", [16 << 20, 200])
def test_benchmark_matches_equal_brute_force(spark, part_bytes):
    rng = random.Random(12)
    vocabulary = ["a", "b", "Ä", "x9", "The"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(f"i{k}", text(rng.choice((0, 1, 2, 9, 10, 14, 40)))) for k in range(12)] + [("n", None)]
    docs = [text(rng.randrange(60)) for _ in range(40)] + [None, ""]
    docs += [f"{text(5)}, {items[k][1]}. {text(7)} {items[k][1][4:]}" for k in range(12)]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string")
    got = {r.doc_id: r for r in suffix_decontam.find_matches(frame, benchmark, part_bytes=part_bytes).collect()}
    for d, (n, hit, names, longest) in enumerate(_brute_matches(docs, items)):
        r = got[d]
        assert r.n_words == n and r.hit_items == names
        assert {w for s in r.hit_spans for w in range(s.start, s.start + s.words)} == hit
        assert {m.item: (m.start, m.item_start, m.words) for m in r.longest_matches} == longest, d


def test_contamination_equals_brute_force(spark):
    docs = ["Alpha beta gamma DELTA epsilon zeta eta theta iota kappa lambda", "beta, gamma; delta", None, "", "x",
            "mu alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "gamma delta short item here", "lone"]
    items = [("a", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), ("b", "Short item"), ("c", "!!"), ("d", None), (None, "lone"),
             ("e", "short item")]
    documents = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    for part_bytes in (1 << 20, 40):  # in one part, and item by item
        out = {r.doc_id: r for r in suffix_decontam.find_matches(documents, benchmark, part_bytes=part_bytes).collect()}
        assert [(s.start, s.words) for s in out[0].hit_spans] == [(0, 11)] and out[0].hit_items == ["a"]
        assert out[1].hit_spans == [] and out[2].n_words == 0
        assert [(s.start, s.words) for s in out[5].hit_spans] == [(1, 11)]
        assert out[6].hit_items == ["b", "e"] and [(s.start, s.words) for s in out[6].hit_spans] == [(2, 2)]
        assert out[7].hit_items == [""]
    assert suffix_decontam.remove_contaminated(documents, benchmark).count() == 4
    assert suffix_decontam.remove_contaminated(documents, benchmark.limit(0)).count() == len(docs)


# ---- 7: fingerprints

def test_equal_substrings_share_phrases():
    rng = random.Random(8)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    level = [set(phrase_fingerprint.parse(*utf8(pa.array([t])))[2][0].tolist()) for t in ("xy" + shared, "something else " + shared + "!")]
    assert len(level[0] & level[1]) > 0.9 * len(level[0])


def test_neighbours_and_edits(odd_documents, odd_texts):
    rows = phrase_fingerprint.compare_neighbours(odd_documents.where("doc_id is not null")).orderBy("key", "edited").collect()
    order = sorted([(i, t or "") for i, t in enumerate(odd_texts) if i != 3] + [(6, odd_texts[6])])
    want = [a[:len(a) - len(a) // 4] + b[:len(a) // 4] for (_, a), (_, b) in zip(order, order[1:] + order[:1])]
    assert sorted(r.edited for r in rows) == sorted(want)
    same = {r.fingerprint for r in rows if r.key in (6, 7)}
    assert len(same) == 1 and all(0 <= r.near_next <= 1 for r in rows)
    assert phrase_fingerprint.compare_neighbours(odd_documents.limit(0)).count() == 0


# ---- 9: language model

def test_language_model(documents, texts):
    rows = {r.key: r for r in suffix_tree_lm.score_texts(documents, F.col("doc_id") % 5 != 1).collect()}
    count = collections.Counter()
    tokens = {d: [*bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode()).split(), None] for d, t in texts.items()}
    for d, t in tokens.items():
        if d % 5 != 1:
            count.update(t)
    total, kinds = sum(count.values()), len(count)
    for d, t in tokens.items():
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in t)
        r = rows[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(count[w] > 0 for w in t), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    held = [rows[d] for d in tokens if d % 5 == 1]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def _tree(training, depth, often, least, divergence, discount):
    """The tree by its definition, with dictionaries: kept contexts, and a token's probability after some words."""
    ended = lambda t: [*t.encode().lower().split(), None]
    after = collections.defaultdict(collections.Counter)
    for t in map(ended, training):
        for i, w in enumerate(t):
            for length in range(min(depth, i) + 1):
                after[tuple(t[i - length:i])][w] += 1
    total, kinds = sum(after[()].values()), len(after[()])
    stored = {c: {w: n for w, n in seen.items() if n >= least} for c, seen in after.items() if sum(seen.values()) >= often}
    kept = set()

    def smoothed(context, w, below):
        n = sum(after[context].values())
        back = 1 - sum(k - discount for k in stored[context].values()) / n
        return max(stored[context].get(w, 0) - discount, 0) / n + back * below, back

    def probability(context, w):
        p = (after[()][w] + 0.5) / (total + 0.5 * (kinds + 1))
        for length in range(1, len(context) + 1):
            if context[len(context) - length:] in kept:
                p = smoothed(context[len(context) - length:], w, p)[0]
        return p

    for c in sorted((c for c in stored if c and stored[c]), key=len):
        below = {w: probability(c[1:], w) for w in stored[c]}
        rest = sum(after[c].values()) - sum(stored[c].values())
        gain = sum(n * math.log(smoothed(c, w, below[w])[0] / below[w]) for w, n in stored[c].items())
        if gain + rest * math.log(smoothed(c, None, 0)[1]) >= divergence:
            kept.add(c)
    score = lambda t: sum(math.log10(probability(tuple(t[max(0, i - depth):i]), w)) for i, w in enumerate(t))
    return kept, after, probability, lambda docs: [score(t) for t in map(ended, docs)]


def test_language_model_distributions_sum_to_one(texts):
    """Over the vocabulary and one unseen word, after any context."""
    kept, after, probability, _ = _tree(list(texts.values())[:60], 2, 8, 3, 2.0, 0.75)
    for c in sorted(kept, key=str)[:20]:
        assert math.isclose(sum(probability(c, w) for w in [*after[()], b"-"]), 1, rel_tol=1e-9)


@pytest.mark.parametrize("chunk_bytes", [16 << 20, 4000])
def test_language_model_equals_brute_force(spark, monkeypatch, chunk_bytes):
    """Contexts of rare words are in the tree too."""
    monkeypatch.setattr(suffix_tree_lm, "CHUNK_BYTES", chunk_bytes)
    rng = random.Random(9)
    rare = "blue heron sits red heron flies"  # four times among 45,000 tokens
    docs = [" ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(300)) for _ in range(200)]
    docs = [f"{rare} {t} {rare}" if d in (3, 9) else t for d, t in enumerate(docs)] + [rare, f"x {rare}", "", "unseen words"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    for depth, often, least, divergence in ((2, 4, 2, 2.0), (3, 2, 2, 3.0), (2, 8, 3, 2.0)):
        kept, _, _, scores = _tree(docs[:150], depth, often, least, divergence, 0.75)
        if often <= 4:
            assert {(b"heron",), (b"blue", b"heron"), (b"red", b"heron")} <= kept
        got = {r.key: r.score for r in suffix_tree_lm.score_texts(
            df, F.col("doc_id") < 150, depth=depth, often=often, least=least, divergence=divergence).collect()}
        for d, score in enumerate(scores(docs)):
            assert math.isclose(got[d], score, rel_tol=1e-9, abs_tol=1e-9), (depth, d)


def test_language_model_of_distant_equal_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree_lm, "CHUNK_BYTES", 200)
    rows = [(k, "the same words in a row again and again") for k in (-(1 << 63), (1 << 63) - 1, None, None, 5, 5)] * 3
    out = suffix_tree_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True)).collect()
    assert len(out) == len(rows) and len({r.score for r in out}) == 1
    assert sorted(str(r.key) for r in out) == sorted(str(k) for k, _ in rows)


def test_language_model_messages():
    rng = np.random.default_rng(3)
    for keys in (np.array([7], np.uint64), np.array([0, 1, 1 << 63], np.uint64), np.unique(rng.integers(0, 1 << 64, 5000, np.uint64))):
        assert (suffix_tree_lm._unpacked_keys(suffix_tree_lm._packed_keys(keys)) == keys).all()
        assert (suffix_tree_lm._unpacked(suffix_tree_lm._packed(keys)) == keys).all()


@pytest.mark.parametrize("held", [2_000_000, 50])
def test_language_model_sequences_are_counted_by_messages(spark, monkeypatch, held):
    """A row for each distinct sequence of a task took op9 over its CPU time: now a few for each key range."""
    monkeypatch.setattr(suffix_tree_lm, "_COUNTED_KEYS", held)
    rng = random.Random(4)
    texts = [" ".join(f"w{int(rng.paretovariate(0.8))}" for _ in range(200)) for _ in range(60)] + [None, ""]
    df = spark.createDataFrame([(t or "",) for t in texts], "text string").repartition(5)
    messages = suffix_tree_lm._pair_counts(df, 7)
    assert 0 < messages.count() <= 5 * 7 and {r.range for r in messages.select("range").collect()} == set(range(7))
    words = [[*(t or "").encode().split(), None] for t in texts]
    want = collections.Counter(collections.Counter(p for w in words for p in zip(w, w[1:])).values())
    for least in (1, 3):
        got = suffix_tree_lm._summed(messages, 7, least).collect()
        assert len({(r.context, r.parent) for r in got}) == len(got)
        assert collections.Counter(r.n for r in got) == {n: k for n, k in want.items() if n >= least}


def test_language_model_counts_by_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree_lm, "COUNTED_BYTES", 2000)
    rng = random.Random(8)
    docs = [" ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(100)) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    got = {r.key: r.score for r in suffix_tree_lm.score_texts(df, F.col("doc_id") < 60).collect()}
    for d, score in enumerate(_tree(docs[:60], 2, 8, 3, 2.0, 0.75)[3](docs)):
        assert math.isclose(got[d], score, rel_tol=1e-9)


def test_language_model_order_of_keys():
    rng = np.random.default_rng(5)
    top = np.uint64((1 << 64) - 1)
    for keys in (np.zeros(0, np.uint64), np.array([7], np.uint64), top - rng.integers(0, 9, 1000).astype(np.uint64),
                 rng.integers(0, 1 << 64, 5000, np.uint64), rng.integers(0, 300, 5000).astype(np.uint64) << np.uint64(3)):
        order, own = suffix_tree_lm._order(keys)
        assert order.tolist() == np.argsort(keys, kind="stable").tolist() and own.tolist() == sorted(keys.tolist())


def test_sequence_keys_equal_spark(spark):
    values = np.array([0, 1, 2, -1, 1 << 62, -(1 << 63), 987654321987654321], np.int64)
    rows = [(int(a), int(b)) for a in values for b in values]
    want = [r.h for r in spark.createDataFrame(rows, "a long, b long").selectExpr("xxhash64(a, b) as h").collect()]
    a, b = (np.array(x, np.int64).view(np.uint64) for x in zip(*rows, strict=True))
    assert suffix_tree_lm.sequence_key(a, b).view(np.int64).tolist() == want


def test_language_model_of_odd_rows(odd_documents):
    out = suffix_tree_lm.score_texts(odd_documents, F.col("doc_id") < 3).collect()
    assert len(out) == odd_documents.count() and all(r.n_tokens >= 1 and r.score < 0 for r in out)
    assert all(r.train_tokens == 0 for r in suffix_tree_lm.score_texts(odd_documents, F.lit(False)).collect())
    assert suffix_tree_lm.score_texts(odd_documents.limit(0), F.lit(True)).count() == 0


def test_digest_of_edited_text(documents):
    row = phrase_fingerprint.compare_neighbours(documents, digest=True).first()
    assert len(row.edited) == len(hashlib.sha256().hexdigest())


# ---- 5 and 7 by their definitions, one text at a time

def _features(t):
    raw = t.encode()
    words = [w for w in re.split(rb"[\t\n\x0b\x0c\r ]+", raw) if w]
    lines = [x for x in raw.split(b"\n") if x]
    low = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    lower_lines = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in lines]
    space, stop = set(b"\t\n\x0b\x0c\r "), set(b".,;:?")
    letter = lambda c: 65 <= c <= 90 or 97 <= c <= 122 or c >= 128
    symbol = lambda c: not (c in space or letter(c) or 48 <= c <= 57 or c in stop)
    share = lambda part, whole: math.asin(math.sqrt(min(max(part / max(whole, 1), 0), 1)))
    count = lambda rule: sum(map(rule, raw))
    pairs = list(zip(low, low[1:]))
    n = len(words)
    return [math.log1p(n), math.log1p(len(raw) / max(n, 1)), math.log1p(n / max(len(lines), 1)),
            share(count(lambda c: 65 <= c <= 90), count(letter)), share(count(symbol), len(raw)), share(count(lambda c: 48 <= c <= 57), len(raw)),
            share(count(lambda c: c in stop), len(raw)), share(sum(len(w) == 1 and symbol(w[0]) for w in words), n),
            share(sum(symbol(w[-1]) for w in words), n), share(len(set(low)), n),
            share(max(collections.Counter(low).values(), default=0), n), share(len(pairs) - len(set(pairs)), len(pairs)),
            share(len(lines) - len(set(lower_lines)), len(lines)), share(sum(len(w) <= 3 for w in words), n)]


def test_quality_features_equal_brute_force(spark, texts, odd_texts):
    rows = [*list(texts.values())[:80], *(t or "" for t in odd_texts), "A\nb\n\nA\nb a B", "!! ? 12 é"]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    got = {r["key"]: r.features for r in quality_qda.document_features(frame).collect()}
    for i, t in enumerate(rows):
        assert np.allclose(got[i], _features(t), atol=1e-9), i


def test_quality_scores_equal_the_formula(spark, documents, texts):
    """Log densities of the shrunk classes by determinant and inverse, on features computed apart."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = {r.doc_id: r.quality for r in labels.collect() if r.quality in (0, 1)}
    x = {d: np.array(_features(t)) for d, t in texts.items()}
    train = [(x[d], c) for d, c in known.items() if d in x]
    every = np.array([v for v, _ in train])
    center, scale = every.mean(0), every.std(0)
    scale = np.where(scale > 1e-6, scale, 1)
    z = [(every[[c == k for _, c in train]] - center) / scale for k in (0, 1)]
    own = [np.cov(a.T, bias=True) for a in z]
    within = sum(c * len(a) for c, a in zip(own, z, strict=True)) / len(every)
    d = len(center)

    def log_density(v, k):
        cov = (1 - quality_qda.POOLED) * own[k] + quality_qda.POOLED * within
        cov = (1 - quality_qda.DIAGONAL) * cov + quality_qda.DIAGONAL * (np.diag(np.diag(cov)) + 0.05 * np.eye(d))
        u = (v - center) / scale - z[k].mean(0)
        return math.log(len(z[k]) / len(every)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * u @ np.linalg.inv(cov) @ u

    got = {r["key"]: r.score for r in quality_qda.quality_scores(documents, labels).collect()}
    for i, v in x.items():
        difference = np.clip(log_density(v, 0) - log_density(v, 1), -700, 700)
        assert math.isclose(got[i], 1 / (1 + math.exp(difference)), rel_tol=1e-4, abs_tol=1e-7), i


def _parsed(symbols):
    """Phrase starts of one sequence, symbol by symbol."""
    def coin(previous, own):
        if previous == own:
            return 0
        bit = ((previous ^ own) & -(previous ^ own)).bit_length() - 1
        return 2 * bit + (own >> bit & 1)

    labels, n = symbols, len(symbols)
    for _ in range(3):
        labels = [coin(labels[i - 1] if i else 0, labels[i]) for i in range(n)]
    same = [i > 0 and symbols[i] == symbols[i - 1] for i in range(n)] + [False]
    start = [same[i + 1] and not same[i] if i + 1 < n else False for i in range(n)]
    end = [i > 0 and not same[i] and same[i - 1] for i in range(n)]
    peak = [0 < i < n - 1 and labels[i] > labels[i - 1] and labels[i] >= labels[i + 1] and not same[i] for i in range(n)]
    cut = [i == 0 or peak[i] or start[i] or end[i] for i in range(n)]
    return [i for i in range(n) if cut[i] and not (peak[i] and cut[i - 1] and not start[i] and not end[i])]


def test_phrases_equal_brute_force(texts):
    rng = random.Random(21)
    rows = [*list(texts.values())[:25], "", "a", "aa", "ab", "aaaaabbbb", "日本日本日本", *("".join(rng.choice("ab c") for _ in range(50)) for _ in range(40))]
    data, bounds = utf8(pa.array(rows, pa.large_string()))
    symbols, at = [list(t.encode()) for t in rows], bounds
    level_symbols = data
    for level in range(3):
        cuts = phrase_fingerprint.cut_points(level_symbols, at).tolist()
        want = [int(at[i]) + c for i, own in enumerate(symbols) for c in _parsed(own)]
        assert cuts == want, level
        level_symbols = phrase_fingerprint._names(level_symbols, np.array(cuts), level)
        at = np.searchsorted(cuts, at)
        symbols = [[int(x) for x in level_symbols[a:b]] for a, b in zip(at[:-1], at[1:], strict=True)]


def test_fingerprints_are_slots_of_least_names(texts):
    """Each text alone, its slots from the sets of its phrase names."""
    rows = [t for t in list(texts.values())[:20] if t]
    data, bounds = utf8(pa.array(rows, pa.large_string()))
    got = phrase_fingerprint.fingerprints(data, bounds)
    for i, t in enumerate(rows):
        levels = phrase_fingerprint.parse(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        for slot in range(phrase_fingerprint.SHORT_SLOTS + phrase_fingerprint.LONG_SLOTS):
            names = set(levels[1 if slot < phrase_fingerprint.SHORT_SLOTS else 2][0].tolist())
            seed = int(phrase_fingerprint._SEEDS[slot])
            light = lambda x: (y := (x ^ seed) * 0xD6E8FEB86659FD93 % (1 << 64)) ^ y >> 32  # noqa: E731, B023
            least = np.array([min(map(light, names))], np.uint64)
            assert got[i, slot] == int(phrase_fingerprint.mix(least)[0]) & 0xFFFF


def test_order_of_equal_keys_does_not_depend_on_partitions(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(3, "".join(rng.choice("abc de") for _ in range(rng.randrange(60)))) for _ in range(300)], "doc_id long, text string")
    key, seen = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(key)
    try:
        for n in ("1", "8"):
            spark.conf.set(key, n)
            seen.append(sorted(r.edited for r in phrase_fingerprint.compare_neighbours(df.repartition(int(n))).collect()))
    finally:
        spark.conf.set(key, before)
    assert seen[0] == seen[1]
