"""The pipeline on clashing names, null and repeated ids, equal rows and empty tables."""

import corpus_pipeline
from citeloom.llm.jaccard import keep_one_of_each
from citeloom.llm.mixing import mixed, placed

NAMES = ("position", "mix_file", "mix_index", "mix_start", "mix_row", "ids", "exact", "rank", "row", "file", "index", "start", "tie", "lane", "gone_id", "again_id")


def prose(i, n=150):
    """Words that no other document has, in sentences."""
    return "\n".join(" ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{i}" for k in range(j, j + 15)) + "." for j in range(0, n, 15))


def documents(spark, rows):
    more = ", ".join(f"{c} int" for c in NAMES)
    return spark.createDataFrame([(*r, *range(len(NAMES))) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {more}")


ROWS = [(i, prose(i), "en", f"src{i % 7}", 0) for i in range(60)] + [(None, prose(900), "en", "src1", 0), (None, prose(901), None, None, 0), (3, prose(3), "en", "src3", 0), (5, prose(905), "en", "src5", 0)]


def run(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return corpus_pipeline.run(spark, str(tmp_path))


def test_clashes_nulls_and_repeats(spark, tmp_path):
    docs = documents(spark, ROWS)
    got = run(spark, tmp_path, docs).collect()
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, corpus_pipeline.quality(spark, docs, str(tmp_path)), str(tmp_path)).collect()}
    assert sorted(r.position for r in got) == list(range(len(got)))
    assert len(got) == len(kept) > 50  # the equal row of 3 is gone, both texts of 5 stay
    assert sum(r.doc_id == 3 for r in got) == 1 and sum(r.doc_id == 5 for r in got) == 2 and sum(r.doc_id is None for r in got) == 2


def test_empty(spark, tmp_path):
    assert run(spark, tmp_path, documents(spark, ROWS).limit(0)).collect() == []


def test_every_stage_keeps_the_columns(spark, tmp_path):
    docs = documents(spark, ROWS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *NAMES]


def test_rows_of_one_id_have_one_order(spark):
    """Two ways of dealing the same rows give the same positions."""
    rows = [(1, prose(i, 15), "en", "src0", i) for i in range(200)] + [(None, prose(i, 15), "en", "src1", i) for i in range(200)]
    docs = documents(spark, rows)
    places = [{r.n_chars if r.doc_id else -1 - r.n_chars: r.position for r in placed(docs.repartition(n, *by), {"src0": 3}, keep=["n_chars"]).collect()} for n, by in ((1, []), (7, ["text"]))]
    assert len(places[0]) == 400 and places[0] == places[1]
    assert mixed(docs, {"src0": 3}).count() == 400


def test_doubled_table_leaves_one_of_each(spark):
    docs = documents(spark, ROWS[:60])
    assert sorted(r.doc_id for r in keep_one_of_each(docs.unionByName(docs)).collect()) == list(range(60))
