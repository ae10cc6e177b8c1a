"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.llm import p1_split, p2_truncated, p3_wrapper, p4_pairs, p5_encoding, p6_align, p7_pack, p8_mix, p9_subjects, tokens
from inkloom.runtime import materialize, table


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    return p1_split.split_oversized(table(spark, d, "segments"), table(spark, d, "books"), table(spark, d, "size_limits"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_pieces(spark, d).where("piece_no = 2").select("row_id")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_truncated.truncated(table(spark, d, "segments")).where("cut").select("row_id")


def p2_rates(spark: SparkSession, d: str) -> DataFrame:
    return p2_truncated.rates(p2_truncated.truncated(table(spark, d, "segments")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_wrapper.boilerplate_lines(p3_wrapper.main_bodies(table(spark, d, "crawl_pages")))


def p3_bodies(spark: SparkSession, d: str) -> DataFrame:
    return p3_wrapper.main_bodies(table(spark, d, "crawl_pages")).select("page_id", "heading", "body")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_pairs.defects(table(spark, d, "translations"), table(spark, d, "segments"))


def p5_restored(spark: SparkSession, d: str) -> DataFrame:
    return p5_encoding.repair_fields(table(spark, d, "crawl_pages"), "page_id")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_restored(spark, d).select("page_id", "field_name")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_align.align(table(spark, d, "bilingual"))


def token_sizes(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, source and tokens of all documents, written once."""
    return materialize(tokens.token_counts(table(spark, d, "documents"), "text", ["doc_id", "source"]), "sizes")


def p7_pack_containers(spark: SparkSession, d: str) -> DataFrame:
    return p7_pack.pack(token_sizes(spark, d), table(spark, d, "pack_caps"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    caps = table(spark, d, "pack_caps")
    return p7_pack.fill_report(p7_pack.pack(token_sizes(spark, d), caps), caps)


def p8_mixed(spark: SparkSession, d: str) -> DataFrame:
    return p8_mix.in_order(p8_mix.mix(token_sizes(spark, d), table(spark, d, "mix_targets")))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_targets")
    return p8_mix.share_report(p8_mix.mix(token_sizes(spark, d), targets), targets)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_subjects.subjects_of(table(spark, d, "documents"), table(spark, d, "subject_labels"), table(spark, d, "subjects"))


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    """For each source and subject: documents and characters."""
    docs = table(spark, d, "documents")
    found = p9_found(spark, d)
    return found.join(docs.select("doc_id", "source", "n_chars"), "doc_id").groupBy("source", "subject").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"))


def queries() -> dict:
    return {
        "p1_found": p1_found, "p1_pieces": p1_pieces, "p2_found": p2_found, "p2_rates": p2_rates, "p3_found": p3_found, "p3_bodies": p3_bodies,
        "p4_found": p4_found, "p5_found": p5_found, "p5_restored": p5_restored, "p6_found": p6_found, "p7_pack": p7_pack_containers, "p7_fill": p7_fill,
        "p8_mix": p8_mixed, "p8_shares": p8_shares, "p9_found": p9_found, "p9_composition": p9_composition,
    }


def oracle_sql() -> dict[str, str]:
    white = "".join(f"\\x{{{ord(c):x}}}" for c in p1_split.WHITE_SPACE)
    return {
        "p1_found": f"""
            SELECT s.row_id FROM segments s JOIN books b ON s.book = b.book JOIN size_limits z ON b.split_mode = z.split_mode
            WHERE length(regexp_replace(s.content, '[{white}]', '', 'g')) > z.max_chars""",
    }
