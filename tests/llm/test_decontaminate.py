import pytest
from check_oracle import connect

from quillgrid.llm.decontaminate import CONTAMINATED_SQL, contaminated, drop_contaminated

FOLDER = "/root/testdata/sf0.01"
ITEM = "A farmer in Lisbon sold 12 crates of apples for 30 euros and then 12 crates of pears for 45 euros at the market."


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, ITEM, "x"), (2, None, "x"), (3, "", "x"), (4, "too short to count", "x"), (None, ITEM, "x")],
        "item_id long, text string, total string",
    )


def found(docs, benchmark):
    return {(r.id, r.item_id) for r in contaminated(docs, benchmark).collect()}


def test_documents_like_sql(spark, documents):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    result = sorted(tuple(r) for r in contaminated(documents, benchmark).collect())
    assert result == sorted(connect(FOLDER).execute(CONTAMINATED_SQL).fetchall()) and result


def test_every_whole_passage_is_found(spark, documents):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    expected = {(d.doc_id, b.item_id) for d in documents.collect() for b in items if b.text in d.text}
    assert expected and expected <= found(documents, spark.read.parquet(f"{FOLDER}/benchmark.parquet"))


def test_changed_values_are_found_and_inconsistent_ones_are_not(make_docs, benchmark):
    again = ITEM.replace("12", "7").replace("30", "90").replace("45", "8").replace("Lisbon", "Kyoto")
    broken = ITEM.replace("12", "7", 1)  # one value of the item has become two
    docs = make_docs([
        (1, f"Some words before it. {ITEM} And after."), (2, f"intro\n\n{again.upper().lower().replace('kyoto', 'Kyoto')}"), (3, broken),
        (4, "A farmer in a field sold nothing at all and then went home for the winter with the crates."), (5, ITEM + " " + ITEM),
    ])
    hits = found(docs, benchmark)
    assert {(1, 1), (2, 1), (5, 1)} <= hits and (4, 1) not in hits
    counts = {r.id: r.n_windows for r in contaminated(docs, benchmark).collect()}
    assert counts.get(3, 0) < counts[1]


def test_odd_rows_and_empty_tables(odd_docs, benchmark):
    assert found(odd_docs, benchmark) == set()
    assert found(odd_docs.where("false"), benchmark) == set()
    assert found(odd_docs, benchmark.where("false")) == set()


def test_dropping(make_docs, benchmark):
    docs = make_docs([(1, ITEM), (2, "clean words only"), (None, ITEM), (3, None)])
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3]


def test_main_path_is_native(spark, documents, benchmark):
    plan = contaminated(documents, benchmark)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_capitals_and_names_at_sentence_starts_are_found(make_docs, benchmark, spark):
    ours = spark.createDataFrame([(7, "Lisbon has 3 gates. Lisbon pays 4 guards. In Lisbon 5 kings met."), (8, "Anna Bell Cora Dunn met Emma Ford Gwen Hall met Ida Jones at the old mill")], "item_id long, text string")
    both = benchmark.select("item_id", "text").unionByName(ours)
    docs = make_docs([
        (1, f"BEFORE IT. {ITEM.upper()} AND AFTER."), (2, ITEM.lower()),
        (3, "Kyoto has 9 gates. Kyoto pays 8 guards. In Kyoto 7 kings met."),
        (4, "Kyoto has 9 gates. Turin pays 8 guards. In Kyoto 7 kings met."),
        (5, "ANNA BELL CORA DUNN MET EMMA FORD GWEN HALL MET IDA JONES AT THE OLD MILL"),
        (6, ITEM.upper().replace("12", "7", 1)), (9, "THE FARMER SOLD ALL OF THE APPLES AND WENT HOME FOR THE WINTER WITH THE EMPTY CRATES"),
    ])
    hits = found(docs, both)
    assert {(1, 1), (2, 1), (3, 7), (5, 8)} <= hits
    assert not {d for d, _ in hits} & {9} and (4, 7) not in hits
