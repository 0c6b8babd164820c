import inspect
import os

import corpus_pipeline
import pytest
from conftest import prose, words

from regista.llm import queries

RUDE = ["blorg", "snark", "vextil"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with planted copies, passages, benchmark items and toxic texts among clean ones."""
    out = str(tmp_path_factory.mktemp("corpus"))
    rows, marks = [], []
    for i in range(300):
        text = prose(4000 + i, 80 + i % 60, 5000).split()
        toxic = int(i % 6 == 0)
        if toxic:
            for k in range(3):
                text.insert((7 * i + 13 * k) % len(text), RUDE[(i + k) % 3])
        rows.append((i, " ".join(text)))
        marks.append((i, toxic))
    item, passage = prose(77, 40, 5000), prose(78, 60, 5000)
    rows += [(400, rows[1][1]), (401, rows[1][1] + " end"), (402, f"{prose(80, 90, 5000)} {passage}"),
             (403, f"{passage} {prose(81, 90, 5000)}"), (404, f"{prose(82, 40, 5000)} {item}"), (405, None), (405, None), (406, "")]
    docs = [(d, t, "en", "s", None if t is None else len(t)) for d, t in rows]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(marks, "doc_id bigint, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    return out, dict(rows), item, passage


def test_stages(spark, folder):
    out, texts, item, passage = folder
    docs = spark.read.parquet(f"{out}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, out)
        assert after.columns == docs.columns and after.schema == docs.schema, name
        docs = spark.createDataFrame(after.collect(), after.schema)
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    toxic = {i for i in range(300) if i % 6 == 0}
    assert len(toxic & set(kept["toxicity"])) <= 3
    assert len((set(texts) - toxic) - set(kept["toxicity"])) <= 3
    near = kept["simhash_near_dedup"]
    assert 1 in near and 400 not in near and 401 not in near
    cut = kept["substring_dedup"]
    assert set(cut) == set(near)
    assert passage in cut[402] and "".join(words(cut[403])) == "".join(words(texts[403])[60:])
    assert all(cut[d] == near[d] for d in cut if d != 403)
    assert set(near) - set(kept["decontamination"]) == {404}


def test_run(spark, folder):
    out = folder[0]
    got = corpus_pipeline.run(spark, out).collect()
    docs = {r.doc_id for r in got}
    assert 404 not in docs and 400 not in docs and {1, 402, 403} <= docs


def test_registered():
    assert len(corpus_pipeline.STAGES) == 5 and all(len(inspect.signature(f).parameters) == 3 for _, f in corpus_pipeline.STAGES)
    names = queries.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert set(queries.oracle_sql()) <= set(names)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_agree_with_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    df = queries.queries()[name](spark, "/root/testdata/sf0.001")
    cursor = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect()), key=str) == sorted(cursor.fetchall(), key=str)
