"""Each stage of the pipeline against a brute-force version over what it was given."""

import corpus_pipeline as cp
from tests.llm import test_exact_dedup, test_near_dup
from tests.llm.helpers import odd_rows, words


def _tables(spark, path):
    rows = odd_rows()
    item = " ".join(words(9999, 30))
    for k in range(120):
        good = k % 4 > 0
        w = words(k, 60)
        rows.append((100 + k, " ".join(w) if good else " ".join(f"{x.upper()}!!" for x in w)))
        if k % 10 == 1:
            rows += [(400 + k, rows[-1][1].title()), (600 + k, rows[-1][1] + " end")]
        if k % 15 == 2:
            rows.append((800 + k, " ".join(words(k + 500, 40)) + " " + item))
    frames = {
        "documents": ([(i, t, "en", "s", len(t or "")) for i, t in rows],
                      "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([(100 + k, int(k % 4 > 0), 0) for k in range(120)],
                   "doc_id long, quality int, toxic int"),
        "benchmark": ([(1, item)], "item_id long, text string")}
    for name, (data, schema) in frames.items():
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")


def test_stages(spark, tmp_path):
    _tables(spark, str(tmp_path))
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in cp.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = cp.stored(stage(spark, docs, str(tmp_path)), f"test-{name}")
        if name != "bpe":
            assert docs.columns == columns
            kept[name] = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
            assert set(kept[name]) <= set(before)
        if name == "exact_dedup":
            assert {i for i, *_ in kept[name]} == {
                keep for _, keep, *_ in test_exact_dedup._brute(before)}
        if name == "near_dedup":
            assert {i for i, _ in kept[name]} == {c for _, c, _ in test_near_dup._brute(before)}
        if name == "decontaminate":
            gone = {i for i, _ in before} - {i for i, _ in kept[name]}
            assert gone == {800 + k for k in range(120) if k % 15 == 2}
    good = {i for i, _ in kept["quality"]}
    assert {100 + k for k in range(120) if k % 4 > 0} <= good
    assert not {100 + k for k in range(120) if k % 4 == 0} & good
    assert sorted(r.doc_id for r in docs.collect()) == sorted(i for i, _ in kept["decontaminate"])


def test_empty_documents(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, "
                                       "n_chars long"),
                         ("labels", "doc_id long, quality int, toxic int"),
                         ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
