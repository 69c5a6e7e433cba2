"""Rule reports, schema conformance and exact duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.functions import rules as R
from tidepool.operators import quality as ops
from tidepool.operators.quality import Property
from tidepool.plans import Query, table
from tidepool.plans.crawl import quoted


def _tokens(spark, sf):
    """Each distinct token once with how often it occurs; rules then run once per token."""
    docs = table(spark, sf, "documents")
    tokens = docs.select(F.explode(F.split("text", r"\s+")).alias("token")).filter("token <> ''")
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def rule_report(spark, sf):
    t = F.col("token")
    return ops.rule_report(_tokens(spark, sf), {
        "text_3_to_12": R.is_text(t, minlength=3, maxlength=12), "number": R.in_range(t),
        "to_1000": R.in_range(t, 0, 1000), "ip": R.ip_address(t), "email": R.email(t),
        "email_list": R.email_list(t), "url": R.url(t), "zip": R.number_format(t, R.US_ZIP),
        "visa": R.credit_card(t, "vi"), "state": R.us_state(t), "province": R.ca_province(t),
        "phone_tail": R.number_format(t, ["###-####"]), "phone": R.number_format(t, R.US_PHONE),
        "ssn": R.number_format(t, R.US_SSN), "sin": R.number_format(t, R.CA_SIN),
        "postal_code": R.ca_postal_code(F.replace(t, F.lit("_"), F.lit(" "))),
        "cvv": R.cvv(t, "ax"), "card": F.size(R.card_types(t)) > 0}, weight="n")


def tax_numbers(spark, sf):
    """Numbers made from order keys, some with check digits that fit, in all ways of writing them."""
    key = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.lpad((key * 998_244_353 % 10 ** 11).cast("string"), 11, "0").alias("p"),
        F.lpad((key * 998_244_353 * 13 % 10 ** 14).cast("string"), 14, "0").alias("c"))
    part = lambda c, a, n: F.substring(c, a, n)
    person = F.when(key % 3 == 0, F.col("p")).when(key % 3 == 1, F.concat(
        part("p", 1, 9), F.lit("-"), part("p", 10, 2))).otherwise(F.concat(
            part("p", 1, 3), F.lit("."), part("p", 4, 3), F.lit("."), part("p", 7, 3), F.lit("-"),
            part("p", 10, 2)))
    company = F.when(key % 2 == 0, F.col("c")).otherwise(F.concat(
        part("c", 1, 8), F.lit("/"), part("c", 9, 4), F.lit("-"), part("c", 13, 2)))
    return o.select("o_orderkey", R.br_cpf(person).alias("cpf"), R.br_cnpj(company).alias("cnpj"))


def _closes_sql(digits: str, n: int, weight: str) -> str:
    """Weights go by k, from the right."""
    total = (f"list_sum(list_transform(range(0, {n}), lambda k: ({weight}) * "
             f"substr({digits}, {n} - k::INT, 1)::INT))")
    return f"substr({digits}, {n + 1}, 1)::INT = {total} * 10 % 11 % 10"


def rule_failures(spark, sf):
    c = table(spark, sf, "customer").withColumn("digits", F.substring("c_name", 10, 9))
    return ops.rule_failures(c, {
        "luhn": R.luhn("digits"), "isbn": R.isbn(F.concat(F.lit("0"), F.col("digits"))),
        "balance": R.in_range("c_acctbal", 0, 9000), "short": R.number_format(
            "digits", ["0000000##"])}, "c_custkey")


SPEC = {
    "o_orderkey": Property("integer", minimum=10),
    "o_orderstatus": Property("string", pattern="^[FO]$", max_length=1),
    "o_totalprice": Property("number", maximum=300000.0, max_decimal=1),
    "o_orderpriority": Property("string", min_length=6, enum=("1-URGENT", "2-HIGH", "3-MEDIUM",
                                                              "4-NOT SPECIFIED")),
    "clerk": Property("string"),
    "tags": Property("array", min_items=3, items=Property("string", max_length=9)),
}


def schema_conformance(spark, sf):
    o = table(spark, sf, "orders").withColumn("tags", F.split("o_orderpriority", "[- ]")).withColumn(
        "clerk", F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_orderstatus")))
    return ops.schema_conformance(o, SPEC, "o_orderkey")


def cross_field_errors(spark, sf):
    o = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "dd")
    rows = o.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_totalprice") > 50000, F.lit("big")).otherwise(" ").alias("note"),
        F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey")).alias("buyer"),
        day.alias("day"), F.when(F.col("o_custkey") % 7 > 0, day).alias("day_again"))
    return ops.cross_field_errors(
        rows, "o_orderkey", required={"priority": F.col("note") == "big"},
        depends={"note": ["buyer", "priority"]}, confirms={"day_again": "day"})


def content_fingerprint(spark, sf):
    docs = ops.content_fingerprints(table(spark, sf, "documents"), "text")
    return docs.select("doc_id", "md5", "sha1", "sha256")


def exact_duplicates(spark, sf):
    return ops.exact_duplicates(table(spark, sf, "documents"), "doc_id", "text")


def _whole(pattern: str) -> str:
    return f"regexp_matches(token, {quoted(f'(?i)^(?:{pattern})$')})"


_NUM = "TRY_CAST(token AS DOUBLE)"


def _all(parts: str, test: str, n: str) -> str:
    """As many parts as ``n`` says, each of which meets the test on ``p``."""
    return f"(len({parts}) {n} AND len([p FOR p IN {parts} IF NOT ({test})]) = 0)"


def _host_sql(x: str) -> str:
    """Hosts spelled out in SQL: octets by their value, labels by their characters."""
    dots, colons = f"string_split({x}, '.')", f"string_split({x}, ':')"
    octet = "regexp_full_match(p, '0|[1-9][0-9]*') AND TRY_CAST(p AS INTEGER) <= 255"
    octet = f"coalesce({octet}, false)"
    octal = "regexp_full_match(p, '0+([0-3][0-7][0-7])')"
    group = "regexp_full_match(p, '[0-9a-f]{1,4}')"
    tail = f"string_split({colons}[7], '.')"
    labels = f"string_split(regexp_replace({x}, '[.]$', ''), '.')"
    label = ("length(p) <= 63 AND regexp_full_match(p, '[a-z0-9-]+') AND p NOT LIKE '-%'"
             " AND p NOT LIKE '%-'")
    address = " OR ".join([
        _all(dots, octet, "= 4"), _all(dots, "regexp_full_match(p, '0x0*[0-9a-f][0-9a-f]?')", "= 4"),
        _all(dots, octal, "= 4"),
        f"(regexp_full_match({x}, '0|[1-9][0-9]*') AND coalesce(TRY_CAST({x} AS BIGINT) < 4294967296, false))",
        f"regexp_full_match({x}, '0x0*[0-9a-f]{{1,8}}')", _all(colons, group, "= 8"),
        f"({_all(colons + '[1:6]', group, '= 6')} AND len({colons}) = 7 AND {_all(tail, octet, '= 4')})"])
    name = f"({_all(labels, label, '>= 2')} AND regexp_matches({labels}[-1], '^[a-z]'))"
    return address, name


_ADDRESS, _NAME = _host_sql("lower(token)")
_IP = f"({_ADDRESS})"


def _mail_sql(x: str) -> str:
    address, name = _host_sql(f"lower(regexp_extract({x}, '@([^@]*)$', 1))")
    atoms = f"string_split(regexp_extract({x}, '^(.*)@[^@]*$', 1), '.')"
    good = "regexp_full_match(p, '[-A-Za-z0-9!#$%&''*+/=?^_`{|}~]+')"
    return f"(contains({x}, '@') AND {_all(atoms, good, '>= 1')} AND ({address} OR {name}))"


def _url_sql() -> str:
    rest = "regexp_replace(lower(token), '^(http|https|ftp|ftps)://', '')"
    authority = f"regexp_extract({rest}, '^([^/?#]*)', 1)"
    address, name = _host_sql(f"regexp_replace({authority}, ':[0-9]+$', '')")
    bare, _ = _host_sql(authority)
    tail = f"substr({rest}, length({authority}) + 1)"
    return (f"(({address} OR {name} OR (contains({authority}, ':') AND ({bare}))) AND"
            f" regexp_full_match({tail}, '(/[^?#]*([?][^#]*)?(#[^#]*)?)?'))")


_MAILS = "regexp_split_to_array(regexp_replace(token, '[;,]$', ''), '[;,]')"
_MAIL_LIST = f"(contains(token, '@') AND len([m FOR m IN {_MAILS} IF NOT {_mail_sql('m')}]) = 0)"


def _luhn_sql(text: str) -> str:
    """Sum of the digits from the right, every second one doubled and its digits added."""
    return f"""(list_sum(list_transform(generate_series(1, length({text})),
      lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(reverse({text}), i, 1) AS INTEGER)
        ELSE (CAST(substr(reverse({text}), i, 1) AS INTEGER) * 2) % 10
           + (CAST(substr(reverse({text}), i, 1) AS INTEGER) * 2) // 10 END)) % 10 = 0)"""


_RULES = {
    "text_3_to_12": "length(token) BETWEEN 3 AND 12",
    "number": f"{_NUM} IS NOT NULL AND NOT isnan({_NUM})",
    "to_1000": f"coalesce({_NUM} BETWEEN 0 AND 1000, false)",
    "ip": _IP, "email": _mail_sql("token"), "email_list": _MAIL_LIST, "url": _url_sql(),
    "zip": _whole("\\d{5}|\\d{9}|\\d{5}-\\d{4}"),
    "visa": "CASE WHEN regexp_matches(token, '^[- ]*4([- ]*[0-9]){12}(([- ]*[0-9]){3})?[- ]*$') THEN "
            + _luhn_sql("replace(token, '-', '')") + " ELSE false END",
    "state": _whole("|".join(R.US_STATES + R.US_TERRITORIES + R.US_MILITARY)),
    "province": _whole("|".join(R.CA_PROVINCES)),
    "phone_tail": r"regexp_matches(token, '^\d{3}-\d{4}$')",
    "phone": _whole(r"\d{10}|\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|\d{3}/\d{3}-\d{4}"),
    "ssn": _whole(r"\d{9}|\d{3}-\d{2}-\d{4}"), "sin": _whole(r"\d{9}|\d{3}-\d{3}-\d{3}"),
    "postal_code": _whole(r"[A-Z]\d[A-Z]_\d[A-Z]\d"), "cvv": _whole(r"\d{4}"),
    "card": "regexp_matches(replace(token, '-', ''), '^(4\\d{12}(\\d{3})?|5[1-5]\\d{14}|3[47]\\d{13}|"
            "3(0[0-5]|[68]\\d)\\d{11}|6011\\d{12}|3\\d{15}|(2131|1800)\\d{11}|2(014|149)\\d{11})$')",
}

QUERIES = {
    "rule_report": Query(rule_report, """
        WITH t AS (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS token FROM documents),
        n AS (SELECT count(*) AS n, """ + ", ".join(
            f"count(*) FILTER (WHERE {cond}) AS {name}" for name, cond in _RULES.items())
        + " FROM t WHERE token <> '')\n" + " UNION ALL ".join(
            f"SELECT '{name}' AS rule, n, {name} AS n_pass, n - {name} AS n_fail FROM n"
            for name in _RULES)),
    "tax_numbers": Query(tax_numbers, f"""
        WITH o AS (SELECT o_orderkey,
            lpad((o_orderkey * 998244353 % 100000000000)::VARCHAR, 11, '0') AS p,
            lpad((o_orderkey * 998244353 * 13 % 100000000000000)::VARCHAR, 14, '0') AS c FROM orders)
        SELECT o_orderkey, {_closes_sql('p', 9, 'k + 2')} AND {_closes_sql('p', 10, 'k + 2')}
            AND p <> repeat(p[1], 11) AS cpf,
          {_closes_sql('c', 12, 'k % 8 + 2')} AND {_closes_sql('c', 13, 'k % 8 + 2')}
            AND c <> repeat(c[1], 14) AS cnpj FROM o"""),
    "rule_failures": Query(rule_failures, f"""
        WITH c AS (SELECT *, substr(c_name, 10, 9) AS digits, '0' || substr(c_name, 10, 9) AS book
                   FROM customer)
        SELECT c_custkey, 'luhn' AS rule FROM c WHERE NOT {_luhn_sql('digits')}
        UNION ALL SELECT c_custkey, 'isbn' FROM c WHERE list_sum(list_transform(
          generate_series(1, 10), lambda i: (11 - i) * CAST(substr(book, i, 1) AS INTEGER))) % 11 <> 0
        UNION ALL SELECT c_custkey, 'balance' FROM c WHERE NOT (c_acctbal BETWEEN 0 AND 9000)
        UNION ALL SELECT c_custkey, 'short' FROM c
          WHERE NOT regexp_matches(digits, '^0000000\\d\\d$')"""),
    "schema_conformance": Query(schema_conformance, """
        WITH o AS (SELECT *, CASE WHEN o_orderpriority <> '2-HIGH' THEN o_orderstatus END AS clerk,
                     regexp_split_to_array(o_orderpriority, '[- ]') AS tags FROM orders),
        e AS (
          SELECT 'o_orderkey' AS property, 'less than 10' AS message FROM o
            WHERE o_orderkey < 10
          UNION ALL SELECT 'o_orderstatus', 'not like ^[FO]$' FROM o
            WHERE o_orderstatus NOT IN ('F', 'O')
          UNION ALL SELECT 'o_totalprice', 'more than 300000.0' FROM o
            WHERE o_totalprice > 300000
          UNION ALL SELECT 'o_totalprice', 'more than 1 decimal places' FROM o
            WHERE round(o_totalprice * 100) % 10 <> 0
          UNION ALL SELECT 'o_orderpriority', 'shorter than 6' FROM o
            WHERE length(o_orderpriority) < 6
          UNION ALL SELECT 'o_orderpriority',
            'none of 1-URGENT, 2-HIGH, 3-MEDIUM, 4-NOT SPECIFIED'
            FROM o WHERE o_orderpriority = '5-LOW'
          UNION ALL SELECT 'clerk', 'absent' FROM o WHERE clerk IS NULL
          UNION ALL SELECT 'tags', 'fewer than 3 items' FROM o
            WHERE len(tags) < 3
          UNION ALL SELECT 'tags', 'an item is longer than 9' FROM o
            WHERE len(list_filter(tags, lambda t: length(t) > 9)) > 0)
        SELECT property, message, count(*) AS n FROM e GROUP BY property, message"""),
    "cross_field_errors": Query(cross_field_errors, """
        WITH r AS (SELECT o_orderkey, o_orderstatus <> 'P' AS priority, o_totalprice > 50000 AS note,
            o_custkey % 3 > 0 AS buyer, o_custkey % 7 > 0 AS again FROM orders)
        SELECT o_orderkey, 'priority' AS field, 'required' AS problem FROM r WHERE note AND NOT priority
        UNION ALL SELECT o_orderkey, 'note', 'needs buyer' FROM r WHERE note AND NOT buyer
        UNION ALL SELECT o_orderkey, 'note', 'needs priority' FROM r WHERE note AND NOT priority
        UNION ALL SELECT o_orderkey, 'day_again', 'is not day' FROM r WHERE NOT again"""),
    "content_fingerprint": Query(content_fingerprint, """
        SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, sha256(text) AS sha256
        FROM documents"""),
    "exact_duplicates": Query(exact_duplicates, """
        SELECT sha256(text) AS sha256, count(*) AS copies, min(doc_id) AS first_key
        FROM documents GROUP BY text HAVING count(*) > 1"""),
}
