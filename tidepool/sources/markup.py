"""Records held in markup: HTML tables and outline documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.text import decode_entities, html_to_text


def html_table_extract(pages: DataFrame, table_id: str, key: str = "url",
                       html: str = "html") -> DataFrame:
    """(key, row, heading, value) of the table with the given id; its first row holds headings.

    Cells beyond the last heading are dropped, as they have no attribute to go to.
    """
    quoted = f"[\"']?\\Q{table_id}\\E[\"']?"
    body = F.regexp_extract(
        html, rf"(?is)<table\b[^>]*?\bid\s*=\s*{quoted}[^>]*>(.*?)</table\s*>", 1)
    trs = F.regexp_extract_all(body, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), F.lit(1))
    cell = F.lit(r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]\s*>")
    rows = pages.select(key, trs.alias("_trs")).filter(F.size("_trs") > 1)
    heads = F.regexp_extract_all(F.col("_trs")[0], cell, F.lit(1))
    rows = rows.select(key, heads.alias("_heads"), F.posexplode(F.slice(
        "_trs", F.lit(2), F.size("_trs") - 1)).alias("row", "_tr"))
    cells = rows.select(key, "row", "_heads", F.posexplode(
        F.regexp_extract_all("_tr", cell, F.lit(1))).alias("_at", "_cell"))
    return cells.filter(F.col("_at") < F.size("_heads")).select(
        key, "row", html_to_text(F.get("_heads", F.col("_at"))).alias("heading"),
        html_to_text(F.col("_cell")).alias("value"))


_QUOTED = r"(?:\"[^\"]*\"|'[^']*')"
_OUTLINE = rf"(?s)</outline\s*>|<outline(?=[\s/>])(?:[^>\"']|{_QUOTED})*>"
_TEXT = rf"(?s)^<outline(?:\s+(?!text\s*=)[^\s=]+\s*=\s*{_QUOTED})*\s+text\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"


def outline_items(docs: DataFrame, key: str, xml: str, errors: bool = False) -> DataFrame:
    """(key, item, parent, depth, text) of the nested ``outline`` elements, in document order.

    ``parent`` is null at the top.  A null document has no items.  With ``errors`` there is a further
    column ``error``, null for items, and a document that is not well formed has one row, which says
    so; without, it has none.  Documents are checked by Spark's XML reader, which stops at the end of
    the root element, and their tags are told apart by expressions, so nothing leaves the JVM.
    """
    checked = F.from_xml(F.col(xml), "body STRING, _bad STRING",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    bare = F.regexp_replace(xml, r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "")
    rows = docs.filter(F.col(xml).isNotNull()).select(
        F.col(key), bare.alias("_xml"), checked["_bad"].isNotNull().alias("_bad"),
        F.monotonically_increasing_id().alias("_doc"))

    tags = rows.filter("NOT _bad").select(key, "_doc", F.posexplode(
        F.regexp_extract_all("_xml", F.lit(_OUTLINE), F.lit(0))).alias("_pos", "_tag"))
    closing, empty = F.col("_tag").startswith("</"), F.col("_tag").endswith("/>")
    document = Window.partitionBy("_doc").orderBy("_pos")
    before = document.rowsBetween(Window.unboundedPreceding, -1)
    step = F.when(closing, -1).when(empty, 0).otherwise(1)
    opened = tags.withColumn("depth", F.coalesce(F.sum(step).over(before), F.lit(0)).cast("int"))
    opened = opened.withColumn("item", (F.sum(F.when(closing, 0).otherwise(1)).over(document) - 1)
                               .cast("int")).filter(~closing)
    raw = F.coalesce(F.nullif(F.regexp_extract("_tag", _TEXT, 1), F.lit("")),
                     F.regexp_extract("_tag", _TEXT, 2))
    plain = F.replace(F.translate(raw, "\t\r\n", "   "), F.lit("&apos;"), F.lit("'"))
    text = F.when(F.col("_tag").rlike(_TEXT), decode_entities(plain))
    items = opened.select(key, "_doc", "item", "depth", text.alias("text"))

    # A parent is the last item above on the level before: every item stands once on the level of its
    # siblings, to ask, and once on that of its children, to answer.
    places = F.array(F.struct(F.col("depth").alias("level"), F.lit(None).cast("int").alias("above")),
                     F.struct((F.col("depth") + 1).alias("level"), F.col("item").alias("above")))
    asked = items.withColumn("_at", F.explode(places)).select("*", "_at.*")
    level = Window.partitionBy("_doc", "level").orderBy("item").rowsBetween(
        Window.unboundedPreceding, -1)
    found = asked.withColumn("parent", F.last("above", ignorenulls=True).over(level)).filter(
        "above IS NULL").select(key, "item", "parent", "depth", "text")
    if not errors:
        return found
    none = {"item": "int", "parent": "int", "depth": "int", "text": "string"}
    bad = rows.filter("_bad").select(key, *[F.lit(None).cast(t).alias(c) for c, t in none.items()],
                                     F.lit("not well formed").alias("error"))
    return found.withColumn("error", F.lit(None).cast("string")).unionByName(bad)
