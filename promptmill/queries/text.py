"""Text functions on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import cut_at_stop, halt_at_stop, py_rstrip, py_strip, run_stamp, safe_name
from .registry import query, table

# The order matters: the comma is only looked at in texts without a question mark.
STOPS = ["?", ".\n", ", "]

_SPACE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(31) || chr(32) || chr(133) || chr(160) || chr(8195) || chr(8232) || chr(12288)"


@query(
    """SELECT doc_id, CASE
        WHEN contains(text, '?') THEN split_part(text, '?', 1)
        WHEN contains(text, '.' || chr(10)) THEN split_part(text, '.' || chr(10), 1)
        WHEN contains(text, ', ') THEN split_part(text, ', ', 1)
        ELSE text END AS response FROM documents"""
)
def stop_cut(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", cut_at_stop(F.col("text"), STOPS).alias("response"))


@query(
    """SELECT doc_id, CASE WHEN stop_at IS NULL THEN text ELSE substr(text, 1, stop_at) END AS response FROM (
        SELECT doc_id, text, least(
            CASE WHEN contains(text, '?') THEN strpos(text, '?') END,
            CASE WHEN contains(text, '.' || chr(10)) THEN strpos(text, '.' || chr(10)) + 1 END,
            CASE WHEN contains(text, ', ') THEN strpos(text, ', ') + 1 END) AS stop_at
        FROM documents)"""
)
def stop_halt(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", halt_at_stop(F.col("text"), STOPS).alias("response"))


@query(
    f"""SELECT doc_id, trim(wrapped, {_SPACE}) AS stripped, rtrim(wrapped, {_SPACE}) AS right_stripped FROM (
        SELECT doc_id, {_SPACE} || text || {_SPACE} AS wrapped FROM documents)"""
)
def strip_text(spark, folder):
    space = F.lit("\t\n\x0b\x0c\r\x1c\x1f \x85\xa0  　")
    wrapped = F.concat(space, F.col("text"), space)
    return table(spark, folder, "documents").select(
        "doc_id", py_strip(wrapped).alias("stripped"), py_rstrip(wrapped).alias("right_stripped")
    )


@query(
    r"""SELECT 'customer' AS kind, c_custkey AS id, regexp_replace(c_name || '/v1.0 ä', '[^\p{L}\p{N}_-]', '_', 'g') AS safe FROM customer
    UNION ALL
    SELECT 'supplier', s_suppkey, regexp_replace(s_name || '/v1.0 ä', '[^\p{L}\p{N}_-]', '_', 'g') FROM supplier"""
)
def safe_names(spark, folder):
    def named(name, kind, key, text):
        return table(spark, folder, name).select(
            F.lit(kind).alias("kind"), F.col(key).alias("id"), safe_name(F.concat(text, F.lit("/v1.0 ä"))).alias("safe")
        )

    return named("customer", "customer", "c_custkey", "c_name").unionByName(
        named("supplier", "supplier", "s_suppkey", "s_name")
    )


@query("SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS run_id FROM events")
def run_stamps(spark, folder):
    return table(spark, folder, "events").select("event_id", run_stamp(F.col("ts")).alias("run_id"))
