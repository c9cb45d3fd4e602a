from subtide.plans import quality
from subtide.sources.schemas import CONTRACTS, Contract


def test_all_sixty_checks_are_declared():
    contracts = CONTRACTS.values()
    assert sum(len(c.not_null) for c in contracts) == 51
    assert sum(len(c.unique) for c in contracts) == 3
    assert sum(len(c.accepted) for c in contracts) == 5
    assert sum(len(c.references) for c in contracts) == 1
    assert sum(c.size() for c in contracts) == 60


def test_planted_violations_are_found(spark):
    parents = spark.createDataFrame([(1,)], "id int")
    rows = [(1, "a", 1), (1, "b", 2), (2, "c", None), (3, None, 1), (None, "a", 1)]
    df = spark.createDataFrame(rows, "id int, kind string, parent int")
    contract = Contract(
        "t", not_null=("id", "kind"), unique=("id",), accepted=(("kind", ("a", "b")),), references=(("parent", "p", "id"),)
    )
    assert {r.column_name: r.n_failures for r in quality.not_null_failures(df, contract).collect()} == {"id": 1, "kind": 1}
    assert [(r.value, r.n_records) for r in quality.unique_failures(df, contract).collect()] == [("1", 2)]
    assert [(r.value, r.n_records) for r in quality.accepted_value_failures(df, contract).collect()] == [("c", 1)]
    tables = {"t": df, "p": parents}
    assert [(r.value, r.n_records) for r in quality.reference_failures(df, contract, tables).collect()] == [("2", 1)]
    summary = {(r.check, r.column_name): r.n_failures for r in quality.contract_summary(tables, {"t": contract}).collect()}
    assert summary == {
        ("not_null", "id"): 1, ("not_null", "kind"): 1, ("unique", "id"): 2,
        ("accepted_values", "kind"): 1, ("relationships", "parent"): 1,
    }


def test_profile_and_inferred_contract(spark):
    rows = [(1, "a", 2.0), (2, " ", 0.0), (3, "a", -4.0), (3, "a", -4.0)]
    df = spark.createDataFrame(rows, "id int, name string, amount double").selectExpr("*", "parse_json('{\"k\":1}') AS props")
    seen = {r.column_name: r for r in quality.profile(df).collect()}
    assert (seen["id"].n_distinct, seen["id"].n_unique, seen["id"].top_value) == (3, 2, "3")
    assert (seen["name"].n_blank, seen["name"].top_count) == (1, 3)
    assert (seen["amount"].n_zero, seen["amount"].n_negative, seen["amount"].mean_number) == (1, 2, -1.5)
    assert seen["props"].top_value == '{"k":1}'
    [copies] = quality.duplicate_rows(df).collect()
    assert (copies.n_rows, copies.n_distinct_rows, copies.n_duplicate_rows) == (4, 3, 1)
    inferred = {r.column_name: (r.data_type, r.tests) for r in quality.infer_contract(df.limit(3), "things").collect()}
    assert inferred["amount"][0] == "float" and inferred["props"][0] == "varchar"
    assert inferred["name"] == ("varchar", "not_null")
    whole = spark.createDataFrame([(1, None), (2, "x")], "id int, v string")
    inferred = {r.column_name: (r.data_type, r.nullable, r.tests) for r in quality.infer_contract(whole, "things").collect()}
    assert inferred == {"id": ("integer", False, "not_null,unique"), "v": ("varchar", True, "unique")}
