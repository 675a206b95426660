import duckdb
import pytest

from pyspark.sql import functions as F

import corpus_pipeline as CP
from llm_fixtures import docs  # noqa: F401
from test_decontaminate import plain
from test_jaccard_join import brute as groups
from test_line_dedup import brute as deduped

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for k, (_, stage) in enumerate(CP.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs.collect())
    return out


def test_order_and_columns(steps):
    assert [n for n, _ in CP.STAGES] == ["language_id", "line_dedup", "near_duplicates", "decontamination", "best_fit_packing"]
    for rows in steps[:5]:
        assert rows[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, steps):
    start, lang, lines, near, clean, packed = steps
    assert {r.doc_id for r in lang} == {r.doc_id for r in start if r.text and any(c.isalpha() for c in r.text)}
    assert sorted((r.doc_id, r.text) for r in lines) == sorted((i, t) for i, t, *_ in deduped([(r.doc_id, r.text) for r in lang]))
    assert all(r.n_chars == len(r.text) for r in lines)
    assert {r.doc_id for r in near} == {i for i, _, c in groups([(r.doc_id, r.text) for r in lines]) if i == c}
    items = [plain(r.text).strip() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {r.doc_id for r in near if any(i in plain(r.text) for i in items)}
    assert {r.doc_id for r in clean} == {r.doc_id for r in near} - leaked and leaked
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean}


ODD = [(1, "A line that three documents share, word for word.\nFirst text of its own with a few more words.", None), (1, "The same id but another text altogether, as can happen.", None),
       (2, "A line that three documents share, word for word.\nThe second text goes on in its own way.", None), (None, "No id, and these are the only words it has to say here.", None),
       (None, "No id, and these are the only words it has to say here.", None), (3, "A line that three documents share, word for word.\nThird.", None),
       (4, None, None), (5, "", None), (6, "12 !", None), (7, "No id, and these are the only words it has to say here.", None)]


def through(spark, tmp_path, docs):
    """What every stage gives for a table of documents."""
    out = []
    for k, (_, stage) in enumerate(CP.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        out.append(docs)
    return out


def test_odd_documents(spark, docs, tmp_path):
    """No labels; null and repeated ids; null, empty and letterless texts; further columns."""
    start = docs(*ODD).withColumns({"lang": F.lit(None).cast("string"), "node": F.lit(1), "offset": F.lit("x")}).repartition(3)
    lang, lines, near, clean, packed = through(spark, tmp_path, start)
    key = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    assert key(lang) == sorted(((i, t) for i, t, _ in ODD if t and any(c.isalpha() for c in t)), key=repr)
    shared = ODD[0][1].split("\n")[0]
    assert [(r.doc_id, r.text) for r in lines.where(F.contains("text", F.lit(shared))).collect()] == [(3, ODD[5][1])]
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    assert sorted(i for i, _ in key(near)) == [1, 1, 2, 3, 7] and key(clean) == key(near)  # of three copies the one with an id stays
    for df in (lang, lines, near, clean):
        assert df.columns == start.columns
    assert sorted(r.doc_id for r in packed.collect()) == [1, 1, 2, 3, 7]


def test_empty_documents(spark, docs, tmp_path):
    for df in through(spark, tmp_path, docs((1, "x")).limit(0)):
        assert df.count() == 0


def test_run(spark, steps):
    got = sorted(tuple(r)[:5] for r in CP.run(spark, SF).collect())
    assert got == sorted(tuple(r)[:5] for r in steps[-1])


@pytest.mark.parametrize("name", ["op5_line_dedup", "op8_url_filters", "op9_chat_formatting"])
def test_queries_against_sql(spark, name):
    from yearloom.llm.queries import ORACLE_SQL, QUERIES
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    rows = QUERIES[name](spark, SF)
    assert sorted(rows.columns) == sorted(columns)
    assert sorted((tuple(r) for r in rows.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
