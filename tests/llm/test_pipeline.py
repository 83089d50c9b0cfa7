"""The pipeline's stages against brute force."""
import re

import public_tokenizers
import sentencepiece

import corpus_pipeline as P
from geopulse.llm import common, dart_minhash, piece_bpe, quality_qda, suffix_merge
from tests.llm.test_text_operators import _brute_classes, _removed

SF = "/root/testdata/sf0.001"
PASSAGE = "the old mill by the river stood empty for many years until a young baker came from the north and lit its oven again " * 4


def _rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def _inputs(spark, path, empty):
    """A small folder of tables with planted copies, passages and null ids."""
    own = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
           if r.text and 100 < len(r.text) < 2500][:60]
    good = [t for _, t in own if len(t) > 1200]
    item = next(r for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect() if len((r.text or "").split()) >= 12)
    planted = [(9001, good[0]), (9002, good[0]), (9003, good[0].replace(" ", " odd ", 1)), (None, good[1]), (None, good[1]),
               (9004, f"{good[2]} {PASSAGE}{good[3]}"), (9005, f"{good[4]} {PASSAGE}"), (9006, f"{good[5][:700]} {item.text} {good[5][700:]}"),
               (9007, None), (9008, ""), (None, "alone under no id")]
    docs = spark.createDataFrame([(d, t, "xx", "s", len(t or "")) for d, t in own + planted],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    (docs.limit(0) if empty else docs).write.parquet(f"{path}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return item.text


def _quality(spark, docs, path):
    frame = spark.createDataFrame(list(enumerate(t for _, t in docs)), "row long, text string")
    learned = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet").where(P.crc_mod("doc_id", 3) != 1)
    model = quality_qda.fit_on(learned, labels)
    vectors = quality_qda.document_features(frame, "row", "text")
    good = {r["key"] for r in quality_qda.score(vectors, model).collect() if r["score"] >= 0.5}
    return [d for i, d in enumerate(docs) if i in good]


def _near(docs):
    # the least id of a group, null before all; rows that tie are equal
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    label = _brute_classes({i: t or "" for i, (_, t) in enumerate(order)})
    empty = [i for i, (_, t) in enumerate(order) if not t]  # copies of each other, with no runs to compare
    return [d for i, d in enumerate(order) if label[i] == i and i not in empty[1:]]


def _repeats(docs):
    raws = [(t or "").encode() for _, t in docs]
    return [(d, bytes(b for b, g in zip(raw, gone) if not g).decode(errors="ignore"))
            for (d, _), raw, gone in zip(docs, raws, _removed(raws, P.PASSAGE_BYTES))]


def _clean(docs, items):
    words = lambda t: re.findall(rb"[a-z0-9\x80-\xff]+", (t or "").encode().lower())
    known = set()
    for t in items:
        w = words(t)
        known |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    hit = lambda w: any(tuple(w[i:i + n]) in known for n in {len(k) for k in known} for i in range(len(w) - n + 1))
    return [d for d in docs if not hit(words(d[1]))]


def test_stages_equal_brute_force(spark, tmp_path, monkeypatch):
    item = _inputs(spark, tmp_path, False)
    out, write = {}, P.written

    def kept(df, label, *by):
        out[label] = write(df, label, *by)
        return out[label]

    monkeypatch.setattr(P, "written", kept)
    last = P.run(spark, str(tmp_path))
    before = _rows(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    items = [r.text for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").collect()]
    assert item in items
    stages = {"quality": lambda d: _quality(spark, d, tmp_path), "near_dedup": _near, "repeat_dedup": _repeats,
              "decontaminate": lambda d: _clean(d, items), "tokenize": lambda d: d}
    assert list(stages) == [name for name, _ in P.STAGES]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    for name, brute in stages.items():
        after = _rows(out[f"pipeline-{name}"])
        assert after == sorted(brute(before), key=key), name
        assert after != before or name == "tokenize", f"{name} had nothing to do"
        before = after
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in last.collect():
        assert [i for i in r.piece_ids if i != 2] == library.encode(r.text), r.doc_id


def test_pipeline_of_an_empty_table(spark, tmp_path):
    _inputs(spark, tmp_path, True)
    out = P.run(spark, str(tmp_path))
    assert out.count() == 0 and {"doc_id", "text", "piece_ids"} <= set(out.columns)


def test_near_dedup_when_a_later_scan_splits_elsewhere(spark, tmp_path, monkeypatch):
    """As when executors come or go between the jobs: row numbers must not change."""
    for part in range(12):
        rows = [(100 * part + i, f"doc {part} {i // 2} " * (30 + 40 * part)) for i in range(6)]  # each text twice
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    near = P.dart_minhash.near_duplicates

    def later(*args):
        out = P.written(near(*args), "t-classes")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "2")
        return out

    monkeypatch.setattr(P.dart_minhash, "near_duplicates", later)
    try:
        got = _rows(P.near_dedup(spark, spark.read.parquet(str(tmp_path / "docs")), ""))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert [d for d, _ in got] == [100 * part + i for part in range(12) for i in (0, 2, 4)]


def _python_by_stage(df):
    """Number of Python operators in the plan's top stage, and the most in any."""
    stages, above = [0], []  # above: (indent, stage) of the nodes over a line
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        while above and above[-1][0] >= indent:
            above.pop()
        stage = above[-1][1] if above else 0
        stages[stage] += bool(re.search("InArrow|InPandas|ArrowEval|BatchEval", line))
        if "Exchange" in line:
            stages.append(0)
            stage = len(stages) - 1
        above.append((indent, stage))
    return stages[0], max(stages)


def test_no_task_holds_two_python_workers(spark, tmp_path, monkeypatch):
    """Workers are used again, so a second one for each task adds its memory to all later stages."""
    _inputs(spark, tmp_path, False)
    most, learned = [], []

    def watched(write):
        def run(df, label, *by):
            most.append((label, _python_by_stage(df)[1]))
            return write(df, label, *by)

        return run

    for module in (P, suffix_merge, dart_minhash):
        monkeypatch.setattr(module, "written", watched(module.written))
    fit = quality_qda.fit
    monkeypatch.setattr(quality_qda, "fit", lambda df: learned.append(_python_by_stage(df)) or fit(df))
    P.run(spark, str(tmp_path))
    assert {"repeats-spans", "repeats-of-rows", "pipeline-repeat_dedup", "near-sketches"} <= {label for label, _ in most}
    assert [x for x in most if x[1] > 1] == []
    assert learned == [(0, 1)]  # the moments come on top, in a stage of their own


def test_a_worker_drops_the_model_for_other_operators():
    assert piece_bpe.model(P.PIECE_MODEL) is piece_bpe.model(P.PIECE_MODEL)
    common.release_memory()
    assert piece_bpe.model.cache_info().currsize == 0


def test_large_classes_of_a_long_text_in_parts(spark, monkeypatch):
    """A text's anchors are cut out in several parts, on the merged and on the counted way."""
    monkeypatch.setattr(suffix_merge, "_CUT", 3)
    texts = [f"{PASSAGE}{i} {PASSAGE[100:]}{PASSAGE[:150 + i]}" * 2 for i in range(12)] + ["x" * 2000, "short", "ünï" * 300, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    brute = _repeats([*enumerate(texts)])
    for merge_bytes in (1 << 20, 1000):
        kept = suffix_merge.remove_repeats(docs, length=P.PASSAGE_BYTES, window=P.PASSAGE_BYTES // 2, merge_bytes=merge_bytes, as_text=True)
        assert sorted((r.doc_id, r.kept_text) for r in kept.collect()) == brute
