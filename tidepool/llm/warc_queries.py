"""op2: a WARC record for every page, written and read back, and the SQL that checks it."""

from __future__ import annotations

from tidepool.llm.warc import BASE32, read_warc, write_warc
from tidepool.plans import Query, table
from tidepool.storage import scratch_path

DIGEST = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def op2_warc(spark, sf):
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf, "pages"), path)
    return read_warc(spark, path).select(*DIGEST)


def _sql() -> str:
    digits = " || ".join(
        f"substr('{BASE32}', ((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {shift}) & 31)::INT + 1, 1)"
        for g in range(8) for shift in (15, 10, 5, 0))
    return f"""
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha1(coalesce(html, '')) AS h FROM pages),
first AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM rows)
SELECT page_id, payload_bytes, {digits} AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM first"""


QUERIES = {"op2_warc": Query(op2_warc, _sql())}
