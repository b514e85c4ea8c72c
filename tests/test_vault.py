"""Tokens: distinct, lasting, reversible, agreed on by runs at the same time."""

from millrace.operators.vault import TokenVault
from millrace.session import work_dir


def tokens(store, rows):
    return {r["v"]: r["token"] for r in store.tokenise(rows, "v").collect()}


def test_tokens_last_and_lead_back(spark):
    store = TokenVault(spark, work_dir(spark, "vault"))
    frame = lambda values: spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    first = tokens(store, frame(["a", "b", "a", None]))
    assert first[None] is None and len(set(first.values())) == 3
    second = tokens(TokenVault(spark, store.table.path), frame(["b", "c", "", None]))
    assert second["b"] == first["b"] and len({*first.values(), *second.values()}) == 5
    store.table.compact()
    third = tokens(TokenVault(spark, store.table.path, max_rows=0), frame(["a", "b", "c", ""]))
    assert third == {"a": first["a"], "b": first["b"], "c": second["c"], "": second[""]}
    back = store.restore(spark.createDataFrame([(t,) for t in [*third.values(), "tok-none", None]], "token string"), "token", "v").collect()
    assert {r["token"]: r["v"] for r in back} == {**{t: v for v, t in third.items()}, "tok-none": None, None: None}


def test_runs_at_the_same_time_agree(spark):
    path = work_dir(spark, "vault")
    one, two = TokenVault(spark, path), TokenVault(spark, path)
    rows = spark.createDataFrame([("x",), ("y",)], "v string")
    commit = one.table.commit

    def slow(fresh):
        two.admit(rows)                                  # the other run commits first
        commit(fresh)

    one.table.commit = slow
    assert tokens(one, rows) == tokens(two, rows)
