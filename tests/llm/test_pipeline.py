"""The pipeline stage by stage beside brute force, and on rows that are odd or missing."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from forecourt.llm import lines
from forecourt.llm.queries import read
from forecourt.sources.storage import scratch, written

from .conftest import DOCS, SF, prose
from .test_copies import alike, fuzzy, groups_of, linked_sets, shingle_set
from .test_texts import check_packing, hits_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_beside_brute_force(spark):
    docs = read(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]

    def step(name, df):
        out = written(stages[name](spark, df, SF), name)
        if name != "packing":
            assert out.columns == docs.columns
        return out

    first = step("language_id", docs)
    before, after = plain(docs), plain(first)
    assert set(after) == {k for k, r in before.items() if any(c.isalpha() for c in r.text or "")}

    second = step("line_dedup", first)
    before, after = after, plain(second)
    ids = sorted(before)
    texts = [before[k].text for k in ids]
    places = fuzzy(texts)
    hashes = {(r.doc_id, r.at): r.hash for r in lines.hashed_lines(lines.keyed(first), 5).collect()}
    own = [hashes[ids[d], at] & (2**64 - 1) for d, at, _ in places]
    links, seen = [], {}
    for k, p in enumerate(places):
        links += [(k, seen[p[2]])] if p[2] in seen else []
        seen.setdefault(p[2], k)
    kinds = sorted(seen.values())
    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if (own[a] ^ own[b]).bit_count() <= lines.FAR:
                x, y = places[a][2], places[b][2]
                if alike(x, y):
                    links.append((a, b))
    gone = {places[k][:2] for k, g in enumerate(groups_of(len(places), links)) if g != k}
    want = {}
    for d, k in enumerate(ids):
        kept = [line for at, line in enumerate(texts[d].split("\n")) if (d, at) not in gone]
        if kept:
            want[k] = "\n".join(kept)
    assert {k: r.text for k, r in after.items()} == want and len(gone) > 20
    assert all(r.n_chars == len(r.text) for r in after.values())

    third = step("near_dedup", second)
    before, after = after, plain(third)
    ids = sorted(before)
    groups = groups_of(len(ids), linked_sets([shingle_set(before[k].text) for k in ids]))
    assert set(after) == {ids[k] for k, g in enumerate(groups) if g == k}

    fourth = step("decontamination", third)
    before, after = after, plain(fourth)
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    assert set(after) == {k for k, h in zip(before, hits_of([r.text for r in before.values()], items)) if not h[1]}

    check_packing(step("packing", fourth).collect(), {k: r.text for k, r in after.items()}, 2048)


@pytest.fixture()
def folder(spark, odd):
    path = scratch(spark, "odd")
    odd.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, None), (None, "x"), (2, "no such passage in any of the documents here at all ever")], "item_id long, text string") \
        .write.parquet(f"{path}/benchmark.parquet")
    return path


def test_odd_rows(spark, folder):
    docs = read(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        names = docs.columns
        docs = written(stage(spark, docs, folder), name)
        assert docs.columns == names, name
    kept = [r.doc_id for r in docs.collect()]
    # Copies, and what the same text under no id adds, are gone; texts without letters too.
    assert len(kept) == len(set(kept)) and not {0, 1, 2, 3, 9} & set(kept) and {6, 7, 10, 11} <= set(kept)
    assert corpus_pipeline.run(spark, folder).count() >= len(kept)


def test_near_copies_keep_one_row_of_a_repeated_id(spark):
    text = prose(50, 60)
    rows = [(1, "b " + text, "en", "s", 1), (1, "a " + prose(51, 60), "fr", "s", 2), (1, "a " + prose(51, 60), "de", "s", 2), (2, prose(52, 60), None, None, 3)]
    for k in range(2):
        docs = spark.createDataFrame(rows[::-1] if k else rows, DOCS).repartition(3)
        kept = corpus_pipeline.near_copies(spark, docs, SF).collect()
        assert sorted((r.doc_id, r.text[:2], r.lang) for r in kept) == [(1, "a ", "de"), (2, rows[3][1][:2], None)]


def test_empty_tables(spark, empty):
    path = scratch(spark, "none")
    empty.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0


def test_the_plan_of_a_query_names_no_python_where_none_is_allowed(spark):
    from forecourt.llm import queries

    for name in ("op1_fingerprints", "op2_licence_scan", "op8_line_dedup", "op10_tool_calls"):
        plan = queries.queries()[name](spark, SF)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("MapInArrow", "ArrowEvalPython", "MapInPandas", "Cartesian", "BroadcastNestedLoop")), name


def test_queries_beside_sql(spark):
    from checks.compare import difference, duck
    from forecourt.llm import queries

    con = duck(SF)
    for name, sql in queries.oracle_sql().items():
        assert difference(queries.queries()[name](spark, SF).toPandas(), con.sql(sql).df()) is None, name


def test_names_and_rows_of_every_query(spark):
    from forecourt.llm import queries

    wanted = {
        "op1_fingerprints": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
        "op3_language_id": {"doc_id", "held_out", "lang_pred", "score"},
        "op5_personal_data": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
        "op8_line_dedup": {"doc_id", "n_lines", "n_dropped", "text_sha256"},
    }
    n = read(spark, SF, "documents").count()
    for name, columns in wanted.items():
        found = queries.queries()[name](spark, SF)
        assert columns <= set(found.columns) and found.count() == n, name


def test_held_out_accuracy(spark):
    from forecourt.llm import queries

    truth = read(spark, SF.replace("0.001", "0.01"), "documents").select("doc_id", "lang")
    found = queries.op3_language_id(spark, SF.replace("0.001", "0.01")).where("held_out").join(truth, "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98
