"""Ranked search, conversation trie and line dedup against brute force, with the defined edge cases."""
import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from geopulse.llm import automaton_search, line_dedup, prefix_trie

SF = "/root/testdata/sf0.001"


def _lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


# ---- 11: ranked search

def _terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", _lower(t or ""))


def _ranking(docs, items, top):
    """(item, rank, doc, score) by the definition, in integers; ``docs`` are (id, text) in order of their ids."""
    counts = [(d, collections.Counter(_terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    total, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    wanted = collections.defaultdict(set)
    for name, t in items:
        wanted[name] |= set(_terms(t))
    out = []
    for name, terms in wanted.items():
        found = []
        for d, c in counts:
            m = 100 - 90 + 90 * sum(c.values()) * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score:
                found.append((-score, d is None, d or 0))
        out += [(name, i, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def _ranked(docs, items, **settings):
    return sorted(((r.item, r.rank, r.key, r.score) for r in automaton_search.rank_documents(docs, items, **settings).collect()), key=str)


@pytest.mark.parametrize("part_bytes", [4 << 20, 300])
def test_ranking_equals_brute_force(spark, part_bytes):
    rng = random.Random(3)
    vocabulary = ["the", "The", "of", "ab", "abc", "b", "é", "日本", "x1", "1", "Ä", "ABC"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ".", "-", "\n", "_", " "]) for _ in range(n))
    docs = [(d, text(rng.randrange(40))) for d in range(120)] + [(200 + d, "the abc of the abc") for d in range(30)]
    docs += [(300, None), (301, ""), (302, " .-_ "), (303, "the " * 9000), (None, "abc the é"), (304, "thé abcd ab")]
    items = [(f"i{k}", text(rng.randrange(12))) for k in range(25)] + [("i1", "日本 new"), ("none", None), ("no", " .- "), ("unseen", "qqq zzz"), (None, "abc")]
    got = _ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                  spark.createDataFrame(items, "item_id string, text string"), part_bytes=part_bytes)
    assert got == _ranking(docs, items, 10)


def test_ranking_of_the_given_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = _ranking(sorted((r.doc_id, r.text) for r in docs.collect()), [(r.item_id, r.text) for r in items.collect()], 10)
    assert _ranked(docs, items) == want


def test_ranking_of_odd_and_empty_tables(spark, odd_documents):
    items = spark.createDataFrame([(1, "same text for all"), (2, "word")], "item_id long, text string")
    rows = _ranked(odd_documents, items)
    assert [r[1] for r in rows if r[0] == 1] == [1, 2, 3, 4] and len([r for r in rows if r[0] == 2]) == 1  # a repeated row is ranked twice
    assert _ranked(odd_documents.limit(0), items) == [] == _ranked(odd_documents, items.limit(0))


def test_partial_ranks_keep_the_least_keys_of_equal_scores(spark):
    docs = spark.createDataFrame([(i, "alpha beta") for i in range(500)] + [(1000 + i, "gamma") for i in range(600)], "doc_id long, text string")
    got = _ranked(docs.repartition(16), spark.createDataFrame([(1, "alpha")], "item_id int, text string"))
    assert sorted(r[2] for r in got) == list(range(10)) and {r[1] for r in got} == set(range(1, 11))


# ---- 12: conversation trie

def _turns(rows):
    """Turns (role, text) of every conversation in order."""
    by = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            by[c].append(((turn is not None, turn or 0), hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), (role, text)))
    return {c: [t for *_, t in sorted(x, key=lambda y: y[:2])] for c, x in by.items()}


def _rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def _trie(convs):
    members = collections.defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    children = collections.defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)

    def below(k):
        yield k
        for x in children[k]:
            yield from below(x)

    out = []
    for k, of in members.items():
        tree = list(below(k))
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in tree if x)
        ends = ",".join(map(str, sorted(c for c in of if len(convs[c]) == len(k))))
        out.append((min(of), len(k), min(members[k[:-1]]) if k else None, len(of), len(children[k]),
                    sum(not children[x] for x in tree), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _nodes(df):
    return sorted((tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))
                   for r in df.collect()), key=str)


def _random_conversations(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for i in range(rng.randrange(1, longest)):
            turn = rng.choice([i, i, i, None, 0])
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a b", "a", "", None, " x\ty z ", "é 日本"])))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("span", [1024, 2])
def test_trie_equals_brute_force(spark, monkeypatch, span):
    monkeypatch.setattr(prefix_trie, "_SPAN", span)
    rows = _random_conversations(1, [*range(-25, 70), 10**15, -(10**15)], 7)
    rows += [(c, i, "user", f"long {i % 3}" if i < 30 + c % 2 else f"own {c}") for c in (500, 501, 502, 520) for i in range(60)]
    rows += [(600 + c, i, "user", "copy me") for c in range(40) for i in range(3)] + [(None, 0, "user", "nobody"), (7, 1, "user", "a b"), (7, 1, "user", "a b")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    convs = _turns(rows)
    assert _nodes(prefix_trie.conversation_trie(df)) == _trie(convs)
    turns = prefix_trie.numbered_turns(df)
    assert _nodes(prefix_trie.prefix_trie(*prefix_trie.with_shared_openings(turns))) == _trie(_rebuilt(convs))


def test_turns_are_numbered_across_ranges(spark):
    """One conversation with most rows spans several ranges; its numbers go on from one to the next."""
    rows = [(1, i, "user", str(i)) for i in range(3000)] + [(c, 0, "user", "x") for c in range(2, 60)]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(9)
        turns = prefix_trie.numbered_turns(df).where("conv = 1").collect()
        nodes = prefix_trie.conversation_trie(df).where("conv_id = 1").count()
    finally:
        spark.conf.set(key, before)
    assert nodes == 3001
    assert sorted(r.pos for r in turns) == list(range(1, 3001)) and {r.len for r in turns} == {3000}
    assert len({r.seg for r in turns}) > 1


def test_trie_of_empty_and_turnless_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert _nodes(prefix_trie.conversation_trie(empty)) == []
    # conversation 22 has one turn, takes h turns of conversation 20, which is absent, and drops its first h
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    rows = [(c, 0, "user", "gone")]
    got = _nodes(prefix_trie.prefix_trie(*prefix_trie.with_shared_openings(prefix_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA)))))
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_ends_are_hashed_in_order_across_tasks(spark):
    ids = list(range(-500, 20_000, 3))
    rows = spark.createDataFrame([(2, 5, 6, c) for c in ids] + [(2, 5, 7, 1)], "depth long, a1 long, a2 long, conv long").repartition(11)
    got = {r.a2: r.ends_sha256 for r in prefix_trie.hashed_ends(rows).collect()}
    assert got == {6: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), 7: hashlib.sha256(b"1").hexdigest()}


# ---- 13: line dedup

def _kept_lines(rows, least_chars, least_documents):
    key = lambda line: _lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add((d is not None, d or 0))
    common = {k: max(of) for k, of in holders.items() if len(k) >= least_chars and len(of) >= least_documents}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if common.get(key(x), (d is not None, d or 0)) == (d is not None, d or 0)]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_line_dedup_equals_brute_force(spark, odd_documents):
    rng = random.Random(5)
    lines = ["A common line of text", "a COMMON line of text  ", "\ta common line of text\x0b", "É common line of text", "é common line of text",
             "short", "", " ", "another line that is long", "日本" * 10, "only here and there is it", "\xa0a common line of text"]
    rows = [(d, rng.choice(["\n", "\n", "\n\n"]).join(rng.choice([*lines, f"line {d} of its own with text"]) for _ in range(rng.randrange(9)))) for d in range(80)]
    rows += [(200, None), (201, ""), (202, "\n"), (203, "a common line of text"), (None, "a common line of text\nx"), (None, "only here and there is it"),
             (50, "a common line of text"), (50, "a common line of text"), (204, "a common line of text\n" * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for settings in ((20, 3), (1, 2)):
        got = line_dedup.drop_common_lines(df, least_chars=settings[0], least_documents=settings[1])
        assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=str) == _kept_lines(rows, *settings)
    out = line_dedup.drop_common_lines(odd_documents)
    assert out.columns == ["doc_id", "source", "score", "removed_spans", "text", "n_lines", "n_dropped"]
    assert out.count() == odd_documents.count() and line_dedup.drop_common_lines(odd_documents.limit(0)).count() == 0


def test_line_dedup_of_clashing_names(spark):
    rows = [(i, "this very line is in all of them", 1, 2, 3.0, "r") for i in range(4)]
    df = spark.createDataFrame(rows, "`doc.id` long, text string, id int, drop int, n_lines double, row string")
    out = line_dedup.drop_common_lines(df, key="doc.id").collect()
    assert sorted((r["doc.id"], r.text, r.id, r.drop, r.row, r.n_dropped) for r in out) == [
        (i, "" if i < 3 else rows[0][1], 1, 2, "r", int(i < 3)) for i in range(4)]


def test_line_dedup_runs_no_python(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    plan = line_dedup.drop_common_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
