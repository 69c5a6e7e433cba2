import datetime as dt
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidepool.functions import arrays as A
from tidepool.functions import dates as D
from tidepool.functions import predicates as P
from tidepool.operators import joins, records, sets, stats
from tidepool.operators.hierarchy import tree_flatten
from tidepool.operators.records import page_with_total, sort_key
from tidepool.storage import materialize, sized_join


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, "Bob", 5, ["x", "yy"]), (2, "bab", None, ["z"]), (3, "a*b\nbib", 7, None),
         (4, None, 5, []), (5, "a.b", -1, ["x"])],
        "id INT, name STRING, n INT, tags ARRAY<STRING>")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_record_patterns(table):
    assert ids(records.where(table, {"n": 5})) == [1, 4]
    assert ids(records.where(table, {"n": None})) == [2]
    assert ids(records.where(table, {"name": re.compile("^B", re.I), "n": 5})) == [1]
    assert ids(records.where(table, {"n": lambda c: c > 0})) == [1, 3, 4]
    named = {"small": lambda df: df["n"] < 6}
    assert ids(records.where(table, "small", named)) == [1, 4, 5]
    with pytest.raises(KeyError):
        records.where(table, "nope", named)


@pytest.mark.parametrize("pattern,ci,want", [
    ("b?b", False, [2, 3]), ("b?b", True, [1, 2, 3]), ("a\\*b", False, [3]), ("a.b", False, [5]),
    ("*", False, [1, 2, 3, 5]), ("?", False, []), ("a*", False, [3, 5]), ("*i*", False, [3])])
def test_wildcards(table, pattern, ci, want):
    assert ids(table.filter(P.wildcard("name", pattern, ci))) == want


def test_wildcard_takes_specials_literally():
    assert P.wildcard_regex("a+(b)[c]$^|{}\\d") == r"(?m)^a\+\(b\)\[c\]\$\^\|\{\}d$"


def test_multi_valued_and_boolean(table):
    assert ids(table.filter(P.compare("tags", ":", "x", multi=True))) == [1, 5]
    cond = P.any_of(P.all_of(P.compare("n", ">=", 5), P.negate(P.compare("n", ">", 5))),
                    P.compare("n", "<", 0))
    assert ids(table.filter(cond)) == [1, 4, 5]
    assert ids(table.filter(P.any_column(table, "^7$|BOB", ignore_case=True))) == [1, 3]


def test_conditions(table):
    c = P.condition
    assert ids(table.filter(c("equal", "name", "BOB"))) == [1]
    assert ids(table.filter(c("contains", "name", "A"))) == [2, 3, 5]
    assert ids(table.filter(c("matches", "name", "A"))) == []
    assert ids(table.filter(c("empty", "name"))) == [4]
    assert ids(table.filter(c("less_equal", "n", 5, "number"))) == [1, 4, 5]
    assert ids(table.filter(~c("larger", "n", 5, "number"))) == [1, 2, 4, 5]


def test_null_is_largest(table):
    up = records.record_query(table, None, [records.sort_key("n"), records.sort_key("id")])
    assert [r["id"] for r in up.collect()] == [5, 1, 4, 3, 2]
    down = records.multi_key_sort(table, [records.sort_key("n", True), records.sort_key("id")])
    assert [r["id"] for r in down.collect()] == [2, 3, 1, 4, 5]
    ranked = records.multi_key_sort(table, [records.sort_key("n", ranks={7: 1, -1: 2}),
                                            records.sort_key("id")])
    assert [r["id"] for r in ranked.collect()] == [3, 5, 1, 4, 2]


@pytest.mark.parametrize("deep", [True, False])
def test_pages(table, deep, monkeypatch):
    if deep:
        monkeypatch.setattr(records, "DEEP_PAGE", 0)
    keys = [records.sort_key("n"), records.sort_key("id")]
    page = records.page_with_total(table, keys, 1, 2)
    assert sorted((r["id"], r["total"]) for r in page.collect()) == [(1, 5), (4, 5)]
    assert ids(records.page_with_total(table, keys, 3)) == [2, 3]
    assert records.page_with_total(table, keys, 9, 2).count() == 0
    assert [r["id"] for r in records.top_k(table, keys, 2).collect()] == [5, 1]


SPANS = [(0, 5), (5, 9), (5, 5), (3, 300), (None, 4), (4, None), (290, 1000), (-50, -1), (-1, 0),
         (7, 6), (100, 100_000), (8, 8)]


@pytest.mark.parametrize("limits", [True, False])
def test_overlap_against_all_pairs(spark, limits):
    a = spark.createDataFrame([(i, *s) for i, s in enumerate(SPANS)], "a INT, a0 LONG, a1 LONG")
    b = a.select(F.col("a").alias("b"), F.col("a0").alias("b0"), F.col("a1").alias("b1"))
    got = rows(joins.interval_overlap_join(a, b, ("a0", "a1"), ("b0", "b1"),
                                           include_limits=limits), "a", "b")
    want = []
    for i, (s, e) in enumerate(SPANS):
        for j, (t, f) in enumerate(SPANS):
            if None in (s, e, t, f):
                continue
            if (s <= f and t <= e) if limits else (s < f and t < e):
                want.append((i, j))
    assert got == sorted(want, key=repr)


def test_query_by_example(spark):
    data = spark.createDataFrame([(1, "x", 1), (2, "x", 2), (3, "y", 1)], "id INT, a STRING, b INT")
    ex = spark.createDataFrame([(10, "x", None), (11, None, 1), (12, "x", None), (13, None, None),
                                (14, "y", 2)], "e INT, a STRING, b INT")
    got = rows(joins.query_by_example_join(data, ex, ["a", "b"], "e"), "id", "e")
    assert got == sorted([(1, 10), (2, 10), (1, 11), (3, 11), (1, 13), (2, 13), (3, 13)], key=repr)
    assert joins.query_by_example_join(data, ex.filter("e > 99"), ["a", "b"], "e").count() == 0


def test_tree(spark):
    edges = spark.createDataFrame([("r", "a"), ("r", "b"), ("a", "c"), ("z", "y")],
                                  "parent STRING, child STRING")
    roots = spark.createDataFrame([("r",)], "node STRING")
    assert rows(tree_flatten(edges, roots)) == sorted(
        [("r", 0, "r"), ("a", 1, "r/a"), ("b", 1, "r/b"), ("c", 2, "r/a/c")], key=repr)
    loop = spark.createDataFrame([("r", "r")], "parent STRING, child STRING")
    with pytest.raises(ValueError):
        tree_flatten(loop, roots)
    ring = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "a")], "parent STRING, child STRING")
    with pytest.raises(ValueError):
        tree_flatten(ring, roots)


def test_deep_trees_take_few_rounds(spark, monkeypatch):
    import tidepool.operators.hierarchy as hierarchy
    tables = []
    monkeypatch.setattr(hierarchy, "materialize", lambda df, name: tables.append(name) or materialize(df, name))
    edges = spark.range(1, 1500).select((F.col("id") - 1).alias("parent"), F.col("id").alias("child"))
    extra = spark.createDataFrame([(3, 10_000), (7, 10_000), (10_000, 10_001), (20_000, 20_001)], edges.schema)
    out = tree_flatten(edges.unionByName(extra), spark.createDataFrame([(0,), (1490,)], "node LONG"))
    assert sum(t.startswith("ways") for t in tables) <= 13
    assert out.filter("node = 1499").count() == 2
    deep = out.filter("node = 1499 AND depth = 1499").first()
    assert deep["path"] == "/".join(map(str, range(1500)))
    assert rows(out.filter("node >= 10000"), "node", "depth") == [
        (10_000, 4), (10_000, 8), (10_001, 5), (10_001, 9)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(
        F.col("id") % 50).alias("k"))
    small = spark.range(0, 100, 2).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    small = small.unionByName(small.filter("k = 0").withColumn("v", F.lit(-1).cast("long")))
    salted = sized_join(big, small, ["k"], "id", how, hot_rows=40, max_bytes=0)
    assert rows(salted, *salted.columns) == rows(big.join(small, "k", how), *salted.columns)
    plain = sized_join(big, small, ["k"], "id", how, hot_rows=10_000, max_bytes=0)
    assert plain.count() == salted.count()
    with pytest.raises(ValueError):
        sized_join(big, small, ["k"], "id", "full")


def test_near_and_far_pages_are_the_same(spark):
    df = spark.range(500).select("id", (F.col("id") * 7 % 31).alias("k"))
    keys = [sort_key("k", descending=True), sort_key("id")]
    near = page_with_total(df, keys, 40, 60).collect()
    assert near == page_with_total(df, keys, 40, 60, deep=10).collect() and len(near) == 60


def test_spans_lie_only_on_grids_of_the_other_side(spark):
    a = spark.range(1000).select(F.col("id").alias("a0"), (F.col("id") + F.col("id") % 97).alias("a1"))
    b = spark.range(0, 1000, 50).select(F.col("id").alias("b0"), (F.col("id") + 3).alias("b1"))
    got = joins.interval_overlap_join(a, b, ("a0", "a1"), ("b0", "b1")).count()
    want = a.join(b, (F.col("a0") < F.col("b1")) & (F.col("b0") < F.col("a1"))).count()
    assert got == want


def test_sets(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x INT")
    b = spark.createDataFrame([(2,), (3,)], "x INT")
    assert rows(sets.union(a, b)) == [(1,), (2,), (3,)]
    assert rows(sets.intersection(a, b)) == [(2,)]
    assert rows(sets.difference(a, b)) == [(1,)]
    assert sets.is_subset(b.filter("x = 2"), a).first()[0] is True
    assert sets.is_superset(a, b).first()[0] is False


def test_arrays(spark):
    df = spark.createDataFrame([([3, 1, None, 3, 2], ["a", "b", "c"])], "n ARRAY<INT>, s ARRAY<STRING>")
    r = df.select(
        A.slice_step(F.col("n"), -3), A.slice_step(F.col("n"), 1, 4, 2), A.slice_step(F.col("n"), 0, -9),
        A.sort_by(F.col("n"), [(lambda x: x, False)]), A.sort_by(F.col("n"), [(lambda x: x, True)]),
        A.pick_many(F.col("n"), [0, 9]), A.distinct_filter(F.col("n"), lambda x: x > 1),
        A.scan_left(F.filter("n", lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x),
        A.scan_right(F.filter("n", lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x),
        F.size(A.zip_shortest(F.col("n"), F.col("s")))).first()
    assert list(r) == [[None, 3, 2], [1, 3], [], [1, 2, 3, 3, None], [None, 3, 3, 2, 1], [3, None],
                       [3, 2], [0, 3, 4, 7, 9], [9, 6, 5, 2, 0], 3]


def test_dates(spark):
    when = dt.datetime(2024, 1, 31, 13, 59, 30, 250_000)
    df = spark.createDataFrame([(when,)], "t TIMESTAMP_NTZ")
    def us(*a):
        return (dt.datetime(*a) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    r = df.select(D.epoch_us("t"), D.floor_us("t", "minute", 25), D.floor_us("t", "hour", 5),
                  D.floor_us("t", "week"), D.floor_us("t", "week", first_day=3),
                  D.floor_us("t", "month"), D.date_add("t", "month", 1), D.date_add("t", "year", 1),
                  D.date_add("t", "weekday", 3), D.date_add("t", "weekday", -3),
                  D.date_add("t", "millisecond", -250)).first()
    assert list(r) == [
        us(2024, 1, 31, 13, 59, 30, 250_000), us(2024, 1, 31, 13, 50), us(2024, 1, 31, 10),
        us(2024, 1, 28), us(2024, 1, 31), us(2024, 1, 1), dt.datetime(2024, 2, 29, 13, 59, 30, 250_000),
        dt.datetime(2025, 1, 31, 13, 59, 30, 250_000), dt.datetime(2024, 2, 5, 13, 59, 30, 250_000),
        dt.datetime(2024, 1, 26, 13, 59, 30, 250_000), dt.datetime(2024, 1, 31, 13, 59, 30)]


def test_weekdays_by_counting(spark):
    start = dt.datetime(2024, 3, 1)
    days = [start + dt.timedelta(days=i) for i in range(9)]
    df = spark.createDataFrame([(d, e) for d in days for e in [start + dt.timedelta(days=j)
                                                               for j in range(-20, 25)]],
                               "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    for a, b, n in df.select("a", "b", D.date_diff("a", "b", "weekday")).collect():
        step = 1 if b >= a else -1
        want, day = 0, a
        while day != b:
            day += dt.timedelta(days=step)
            want += step * (day.weekday() < 5)
        assert n == want, (a, b)


def test_quantiles_and_mode(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 10.0), ("b", 4.0),
                                ("b", None), ("b", 4.0), (None, 5.0), (None, 6.0), (None, 6.0),
                                (None, 5.0)], "k STRING, v DOUBLE")
    got = {r["k"]: r for r in stats.quantile_summary(df, ["k"], "v").collect()}
    assert [round(got["a"][c], 6) for c in ("min", "p10", "p25", "med", "p75", "p90", "max")] == [
        1.0, 1.3, 1.75, 2.5, 4.75, 7.9, 10.0]
    assert got["b"]["med"] == 4.0 and got[None]["med"] == 5.5
    assert stats.median(df, [], "v").first()["median"] == 4.5
    modes = {r["k"]: (r["mode"], r["n"]) for r in stats.mode(df, ["k"], "v").collect()}
    assert modes == {"a": (1.0, 1), "b": (4.0, 2), None: (5.0, 2)}
    approx = stats.approx_quantile_summary(df, ["k"], "v").filter("k = 'a'").first()
    assert approx["min"] == 1.0 and approx["max"] == 10.0


def test_many_chunks_give_the_same_quantiles(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("k"), (F.col("id") * 7919 % 1009).cast(
        "double").alias("v"))
    many = stats.quantiles(df, ["k"], "v", {"p": 0.37, "q": 0.9}, chunks=9)
    want = df.groupBy("k").agg(F.percentile("v", F.lit(0.37)).alias("p"),
                               F.percentile("v", F.lit(0.9)).alias("q"))
    for x, y in zip(rows(many), rows(want)):
        assert x == pytest.approx(y)


def test_fit_without_spread(spark):
    df = spark.createDataFrame([("up", 0.0, 1.0), ("up", 1.0, 3.0), ("down", 0.0, 3.0),
                                ("down", 2.0, -1.0), ("flat", 1.0, 2.0), ("flat", 1.0, 4.0)],
                               "k STRING, x DOUBLE, y DOUBLE")
    got = {r["k"]: r for r in stats.best_fit(df, ["k"], "x", "y").collect()}
    assert (got["up"]["slope"], got["up"]["intercept"], got["up"]["r"]) == pytest.approx((2, 1, 1))
    assert (got["down"]["slope"], got["down"]["r"], got["down"]["r2"]) == pytest.approx((-2, -1, 1))
    assert (got["flat"]["slope"], got["flat"]["intercept"], got["flat"]["r"]) == (0.0, 3.0, None)
    y = stats.forecast(stats.best_fit(df.filter("k = 'up'"), [], "x", "y"), [5]).first()["y"]
    assert y == pytest.approx(11)


def test_empty_statistics(spark):
    none = spark.createDataFrame([], "v DOUBLE")
    r = stats.basic(none, [], "v").first()
    assert (r["n"], r["sum"], r["mean"], r["min"]) == (0, 0.0, 0.0, None)


def test_stacked_skips_hidden(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", None), (1, "c", 5), (2, "c", 1), (1, "a", 1)],
                               "x INT, s STRING, y INT")
    got = rows(stats.stacked_series(df, "x", "s", "y", hidden=["z"]), "x", "s", "base", "top")
    assert got == [(1, "a", 0, 3), (1, "b", 3, 3), (1, "c", 3, 8), (2, "c", 0, 1)]
    assert rows(stats.stacked_series(df, "x", "s", "y", hidden=["a"]), "x", "s", "top") == [
        (1, "b", 0), (1, "c", 5), (2, "c", 1)]


def test_rollup_and_bounds(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "x", 4)], "g STRING, h STRING, n INT")
    got = rows(stats.group_rollup(df, ["g", "h"], F.col("n")), "g", "h", "value", "level")
    assert got == sorted([(None, None, 7, 0), ("a", None, 3, 1), ("b", None, 4, 1), ("a", "x", 1, 2),
                          ("a", None, 2, 2), ("b", "x", 4, 2)], key=repr)
    bars = spark.createDataFrame([("s", 2, 9, 1, 3), ("s", 4, 5, 4, 5)],
                                 "s STRING, open INT, high INT, low INT, close INT")
    assert rows(stats.series_bounds(bars, ["s"], ymin=-1)) == [("s", -1.0, 9, 2)]


def test_tax_numbers(spark):
    from tidepool.functions import rules as R
    persons = {"111.444.777-35": True, "11144477735": True, "111444777-35": True, "111.444.777-36": False,
               "11111111111": False, "111.444.77735": False, "abc": False, "": False}
    companies = {"11.222.333/0001-81": True, "11222333/0001-81": True, "112223330001-81": True,
                 "11222333000181": True, "11222333000180": False, "00000000000000": False, "11.222.3330001-81": False}
    for check, cases in ((R.br_cpf, persons), (R.br_cnpj, companies)):
        df = spark.createDataFrame([(v,) for v in cases] + [(None,)], "v STRING")
        got = {r["v"]: r["ok"] for r in df.select("v", check("v").alias("ok")).collect()}
        assert got.pop(None) is False and got == cases


def test_hexadecimal_addresses_and_labels(spark):
    from tidepool.functions import rules as R
    cases = {"0xff.0x0.0x01.0x00ff": True, "0x100.0x0.0x0.0x0": False, "0x0000ffffffff": True, "0x100000000": False,
             "0x": False, "0xg1.0x1.0x1.0x1": False, "0x" + "0" * 40 + "1": True, "0x" + "f" * 40: False}
    df = spark.createDataFrame([(v,) for v in cases], "v STRING")
    got = {r["v"]: r["ok"] for r in df.select("v", R.ip_address("v").alias("ok")).collect()}
    assert got == cases
    hosts = {"a.b": True, "a-.b": False, "-a.b": False, "a" * 63 + ".org": True, "a" * 64 + ".org": False, "a_b.org": False}
    df = spark.createDataFrame([(v,) for v in hosts], "v STRING")
    assert {r["v"]: r["ok"] for r in df.select("v", R.host_name(F.col("v")).alias("ok")).collect()} == hosts
