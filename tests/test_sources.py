import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidepool.functions import rules as R
from tidepool.operators import nested, quality
from tidepool.operators.quality import Property
from tidepool.sources import csv_files, files, markup
from tidepool.storage import scratch_path


def test_csv_quirks(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'id, name ,note\n1,  Bob  ,"say ""hi"""\n\n2,"a, b","two\nlines"\n3,"  padded ",\n4,"",x\n')
    got = rows(csv_files.read_csv(spark, str(tmp_path), ["id", "name", "note"]))
    assert got == [("1", "Bob", 'say "hi"'), ("2", "a, b", "two\nlines"), ("3", "padded", ""),
                   ("4", "", "x")]


def test_csv_round_trip(spark):
    data = [(1, 'q"uote'), (2, "a,b"), (3, None), (4, "tab\there"), (5, "plain"), (6, "x\ny")]
    df = spark.createDataFrame(data, "id INT, v STRING").repartition(3)
    path = scratch_path(spark, "csv")
    csv_files.write_csv(df, path)
    text = "".join(r[0] + "\n" for r in spark.read.text(path).collect())
    assert '1,"q""uote"' in text and '2,"a,b"' in text and "3,\n" in text and "5,plain" in text
    back = rows(csv_files.read_csv(spark, path, ["id", "v"]))
    assert back == sorted([(str(i), v or "") for i, v in data], key=repr)


def test_html_table(spark):
    html = ('<table id="t.1"><tr><td>wrong</td></tr></table><table class=a id=t1><thead><tr><th>A</th>'
            "<th>B &amp; C</th></tr></thead><tr><td> 1 </td><td><b>x</b>y</td><td>extra</td></tr>"
            "<tr><td>2</td></tr></table>")
    df = spark.createDataFrame([("u", html), ("v", "<p>none</p>")], "url STRING, html STRING")
    assert rows(markup.html_table_extract(df, "t1")) == [
        ("u", 0, "A", "1"), ("u", 0, "B & C", "xy"), ("u", 1, "A", "2")]


def test_outline(spark):
    xml = ('<opml><head><title>x</title></head><body><outline text="a &amp; b"><outline text="c">'
           '<outline/></outline></outline><outline text="d"/></body></opml>')
    df = spark.createDataFrame([(7, xml), (8, "<opml><body/></opml>")], "id INT, xml STRING")
    assert rows(markup.outline_items(df, "id", "xml")) == [
        (7, 0, None, 0, "a & b"), (7, 1, 0, 1, "c"), (7, 2, 1, 2, None), (7, 3, None, 0, "d")]


def test_outlines_that_are_not_well_formed(spark):
    fine = ("<opml><!-- <outline text='no'/> --><body><outline title=\"text='x'\" text='it&apos;s &lt;&#65;'>"
            "<outline\ntext = \"a\nb\"></outline></outline><other text='no'/></body></opml>")
    docs = [(1, fine), (2, "<opml><body><outline text='a'></body></opml>"), (3, ""), (4, None), (1, "plain"),
            (5, "<opml><body>" + "<outline text='d'>" * 40 + "</outline>" * 40 + "</body></opml>")]
    df = spark.createDataFrame(docs, "id INT, xml STRING")
    found = markup.outline_items(df, "id", "xml", errors=True)
    assert not any(w in found._jdf.queryExecution().toString() for w in ("Python", "Pandas", "Arrow"))
    got = rows(found)
    bad = "not well formed"
    assert [r for r in got if r[5]] == [(i, None, None, None, None, bad) for i in (1, 2, 3)]
    assert [r for r in got if r[0] == 1 and not r[5]] == [
        (1, 0, None, 0, "it's <A", None), (1, 1, 0, 1, "a b", None)]
    assert [r[1:4] for r in sorted(r for r in got if r[0] == 5)] == [
        (i, i - 1 if i else None, i) for i in range(40)]
    assert markup.outline_items(df, "id", "xml").count() == 42


def test_records_of_one_file_in_many_tasks(spark, tmp_path):
    import random
    rng = random.Random(5)
    cells = ["plain", 'say "hi"', "two\nlines", "a,b", "", '"', '""', "x\n\n,\n\"y\"", " pad "]
    data = [(str(i), rng.choice(cells) * rng.randrange(1, 9), rng.choice(cells)) for i in range(3000)]
    quoted = lambda v: '"' + v.replace('"', '""') + '"' if set(v) & set(',"\n') else v
    text = "id,a,b\n" + "".join(",".join(map(quoted, r)) + rng.choice(["\n", "\n", "\n\n"]) for r in data)
    (tmp_path / "one.csv").write_text(text)
    (tmp_path / "two.csv").write_text('id,a,b\nz,"1\n2",\n')
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "2000")
    try:
        found = csv_files.records(spark, str(tmp_path)).groupBy("file").count()
        assert sorted(r[1] for r in found.collect()) == [2, 3001]
        lines = spark.read.text(str(tmp_path / "one.csv"))
        assert lines.rdd.getNumPartitions() > 30
        got = rows(csv_files.read_csv(spark, str(tmp_path), ["id", "a", "b"]))
        named = csv_files.read_csv(spark, str(tmp_path))
        assert named.columns == ["id", "a", "b"] and rows(named) == got
    finally:
        spark.conf.set(name, before)
    whole = spark.read.options(header=True, quote='"', escape='"', multiLine=True, emptyValue="").csv(
        str(tmp_path / "one.csv"))
    want = sorted([tuple((v or "").strip() for v in r) for r in whole.collect()] + [("z", "1\n2", "")])
    assert got == want == sorted([tuple(v.strip() for v in r) for r in data] + [("z", "1\n2", "")])


def test_files_and_pairs(spark, sf):
    names = {r["name"] for r in files.file_listing(spark, sf, "*.parquet").collect()}
    assert "pages.parquet" in names and len(names) == 14
    df = spark.createDataFrame([(1, '{"a": "x", "b": 2}'), (2, "bad")], "id INT, j STRING")
    assert rows(files.key_value_source(df, "j", ["id"])) == [(1, "a", "x"), (1, "b", "2")]


def test_json_paths(spark):
    doc = '{"a": {"b": [1, {"a": "x"}]}, "c": {"a": null}, "d": "s"}'
    df = spark.createDataFrame([(1, doc), (2, "not json"), (3, "[]")], "id INT, j STRING")
    assert rows(nested.json_path(df, "j", ["id"], ["a", "b", 0])) == [(1, "$['a']['b'][0]", "1")]
    assert rows(nested.json_path(df, "j", ["id"], ["a", "b", "*", "a"])) == [
        (1, "$['a']['b'][1]['a']", "x")]
    found = {r["path"]: r["value"] for r in nested.recursive_find(df, "j", ["id"], "a").collect()}
    assert set(found) == {"$['a']", "$['a']['b'][1]['a']", "$['c']['a']"}
    assert found["$['a']['b'][1]['a']"] == "x"
    assert nested.wildcard_values(df, "j", ["id"]).count() == 3
    deep = '{"in":' * 70 + '{"a": 1}' + "}" * 70
    far = spark.createDataFrame([(1, deep)], "id INT, j STRING")
    assert [r["value"] for r in nested.recursive_find(far, "j", ["id"], "a").collect()] == ["1"]


CASES = {
    "luhn": (R.luhn, ["4242 4242-4242-4242", "79927398713"], ["4242424242424241", "x", None]),
    "ip": (R.ip_address, ["1.2.3.255", "0x0F.0x1.0x2.0x3", "4294967295", "1:2:3:4:5:6:7:8",
                          "1:2:3:4:5:6:1.2.3.4", "0x1F"], ["256.1.1.1", "4294967296", "1.2.3", "a"]),
    "email": (R.email, ["a.b@c.org", "x@1.2.3.4", "o'k@d-e.co"], ["a@b", "a b@c.org", "@c.org"]),
    "emails": (R.email_list, ["a@b.org; c@d.org", "a@b.org"], ["a@b.org;;x", ""]),
    "url": (R.url, ["http://a.org", "a.org:80/x/y.html?q=1#t", "ftp://1.2.3.4/"],
            ["http:/a.org", "http://a", "gopher://a.org"]),
    "isbn": (R.isbn, ["0-306-40615-2", "978-0-306-40615-7", "080442957X"], ["0306406153", "12", "abcdefghij"]),
    "phone": (lambda c: R.number_format(c, R.US_PHONE), ["(111) 111-1111", "111-111-1111 x1", "1111111111"],
              ["11-111-1111", "111-111-1111 x12345"]),
    "zip": (lambda c: R.number_format(c, R.US_ZIP), ["12345", "12345-6789"], ["1234", "12345-678"]),
    "ssn": (lambda c: R.number_format(c, R.US_SSN), ["123-45-6789"], ["123-456-789"]),
    "sin": (lambda c: R.number_format(c, R.CA_SIN), ["123 456 789"], ["123 45 6789"]),
    "state": (R.us_state, ["ca", "NY", "AE"], ["XX", "CAL"]),
    "province": (R.ca_province, ["on", "QC"], ["NY"]),
    "postal": (R.ca_postal_code, ["K1A 0B1", "k1a 0b1"], ["K1A0B", "11A 0B1"]),
    "visa": (lambda c: R.credit_card(c, "vi"), ["4242424242424242"], ["5555555555554444", "4242424242424241"]),
    "enroute": (lambda c: R.credit_card(c, "ER"), ["201400000000009", "214912345678901"], ["301400000000009"]),
    "cvv": (lambda c: R.cvv(c, "ax"), ["1234"], ["123"]),
    "range": (lambda c: R.in_range(c, 0, 10), ["0", "10", "9.5"], ["-1", "10.1", "x", None, "NaN"]),
    "text": (lambda c: R.is_text(c, minlength=2, maxlength=3), ["ab", "abc"], ["a", "abcd", "  ", None]),
}


@pytest.mark.parametrize("name", CASES)
def test_rules(spark, name):
    rule, good, bad = CASES[name]
    df = spark.createDataFrame([(v, True) for v in good] + [(v, False) for v in bad],
                               "v STRING, want BOOLEAN")
    wrong = df.withColumn("got", rule(F.col("v"))).filter("NOT (got <=> want)").collect()
    assert not wrong


def test_card_types(spark):
    df = spark.createDataFrame([("5555-5555-5555-4444",), ("378282246310005",), ("1",)], "v STRING")
    assert [r[0] for r in df.select(R.card_types("v")).collect()] == [["mc", "ec"], ["ax"], []]


def test_reports(spark):
    df = spark.createDataFrame([(1, "a", 5.25, ["x"]), (2, None, 0.5, ["longer", "y"]), (3, "abc", None, [])],
                               "id INT, s STRING, n DOUBLE, t ARRAY<STRING>")
    rules = {"short": R.is_text("s", maxlength=2), "positive": F.col("n") > 0}
    assert rows(quality.rule_report(df, rules)) == [("positive", 3, 2, 1), ("short", 3, 1, 2)]
    assert rows(quality.rule_failures(df, rules, "id")) == [(2, "short"), (3, "positive"), (3, "short")]
    spec = {"s": Property("string", min_length=2), "n": Property("integer", optional=True, max_decimal=1),
            "t": Property("array", min_items=1, items=Property("string", max_length=3))}
    got = {(r["id"], r["property"]): r["message"] for r in quality.schema_errors(df, spec, "id").collect()}
    assert set(got) == {(1, "s"), (2, "s"), (1, "n"), (2, "n"), (2, "t"), (3, "t")}
    assert got[(2, "s")] == "absent"
    assert got[(2, "t")] == "an item is longer than 3"
    wrong = quality.schema_errors(df, {"s": Property("number")}, "id")
    assert rows(wrong, "id", "message") == [(1, "not of type number"), (2, "absent"),
                                            (3, "not of type number")]
    empty = quality.rule_report(df.filter("id > 9"), rules)
    assert rows(empty) == [("positive", 0, 0, 0), ("short", 0, 0, 0)]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id INT, t STRING")
    assert rows(quality.exact_duplicates(df, "id", "t"), "copies", "first_key") == [(2, 1)]
