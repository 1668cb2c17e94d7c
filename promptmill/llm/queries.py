"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from . import langid, quality
from .collisions import nearest
from .collocations import collocations
from .fertility import judge
from .packing import pack_pieces, token_pieces
from .pages import main_texts
from .pieces import round_trip
from .pivots import near_vectors
from .registry import ORACLE, QUERIES, query, table
from .simhash import near_duplicates
from .token_files import read_tokens, write_tokens
from .turn_repair import damaged, repair
from .warc import audit, warc_records

__all__ = ["ORACLE", "QUERIES"]


@query()
def op7_repair_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents, written as grammar-compressed blocks and read back."""
    path = scratch_path(spark, "token-files")
    write_tokens(table(spark, folder, "documents"), path)
    return read_tokens(spark, path).select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@query()
def op9_sum_of_squares_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return pack_pieces(token_pieces(table(spark, folder, "documents")))


@query()
def op3_simhash_anchors(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and the groups that 4 or fewer differing bits link."""
    return near_duplicates(table(spark, folder, "documents"))


def _held_out(docs: DataFrame) -> DataFrame:
    """``docs`` with held_out: a quarter of the documents that nothing is learned from."""
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    return docs.withColumn("held_out", F.coalesce(remainder == 2, F.lit(False)))


@query()
def op6_hyperdimensional_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned without the held-out quarter."""
    docs = _held_out(table(spark, folder, "documents"))
    prototypes = langid.train(docs.filter(~F.col("held_out")))
    return langid.predict(docs, prototypes, ("doc_id", "held_out"))


@query()
def op2_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade and selection of every document, learned from the rated ones."""
    docs = table(spark, folder, "documents")
    return quality.rate(docs, quality.train(docs, table(spark, folder, "labels")))


@query()
def op8_sentencepiece_backtracking(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids of all documents and of the text that these ids decode to."""
    decoded = round_trip(table(spark, folder, "documents"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query()
def op5_pivot_permutations(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors with a cosine of 0.98 or more to one of their label."""
    return near_vectors(table(spark, folder, "embeddings"))


@query()
def op1_collision_counting(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op10_block_tree_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return main_texts(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


_DAMAGED = """
SELECT page_id, CASE WHEN r = 3 THEN 'missing' ELSE 'altered' END AS finding
FROM (SELECT page_id, html, page_id % 53 AS r FROM pages)
WHERE r = 3 OR (r = 11 AND length(html) > 0) OR (r = 29 AND length(html) > 1)
"""


@query(_DAMAGED)
def op4_merkle_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all pages that a damaged replica has lost or altered.

    The replica lacks some records and has the last one or two bytes of other pages zeroed, at places
    that follow from page_id.
    """
    records = materialize(warc_records(table(spark, folder, "pages")), "warc")
    case = F.col("page_id") % 53
    # Four bytes end a record; the ones before them are the last ones of the page.
    flipped = F.concat(F.expr("substring(record, 1, length(record) - 5)"), F.lit(b"\x00"), F.lit(b"\r\n\r\n"))
    zeroed = F.concat(F.expr("substring(record, 1, length(record) - 6)"), F.lit(b"\x00\x00\r\n\r\n"))
    body = F.length("record") - F.instr(F.decode("record", "ISO-8859-1"), "\r\n\r\n") - 7
    broken = F.when((case == 11) & (body > 0), flipped).when((case == 29) & (body > 1), zeroed)
    broken = F.coalesce(broken, F.col("record"))
    replica = records.filter(F.coalesce(case != 3, F.lit(True))).select("file", "offset", broken.alias("record"))
    found = audit(records, replica)
    return found.join(records.select("file", "offset", "page_id"), ["file", "offset"]).select("page_id", "finding")


@query()
def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest role repair of every damaged conversation."""
    return repair(damaged(table(spark, folder, "conversations")))


@query()
def op12_tokenizer_fertility(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts of all documents and which of them fertility bands keep."""
    return judge(table(spark, folder, "documents"))


_PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), runs AS (
    SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM worded, (VALUES (1), (2), (3), (4)) AS v(m)
), counted AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= 30
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang
), cuts AS (
    SELECT lang, phrase, a, m, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM counted WHERE m > 1
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.m, c.k, l.a AS l, r.a AS r,
        CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(l.a AS HUGEINT) + r.a) AS BIGINT) AS score
    FROM cuts c JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')
), worst AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_runs AS (
    SELECT lang, a, m, string_split(phrase, ' ') AS w, unnest(range(2, m)) AS size FROM counted WHERE m > 2
), covered AS (
    SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT *, unnest(range(1, m - size + 2)) AS i FROM inner_runs) GROUP BY ALL
), ranked AS (
    SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.phrase) AS rank
    FROM worst w LEFT JOIN covered o ON o.lang = w.lang AND o.phrase = w.phrase
    WHERE o.longer IS NULL OR CAST(100 AS HUGEINT) * o.longer < CAST(80 AS HUGEINT) * w.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query(_PHRASES)
def op13_rabin_karp_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best collocated phrases of every language, counted over all documents."""
    return collocations(table(spark, folder, "documents"))
