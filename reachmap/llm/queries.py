"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, langid, lattice, multiindex, quality, repair, secrets, simhash, spm, tiling, urlfilter, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": urlfilter.op1_url_filters,
    "op2_language_id": langid.op2_language_id,
    "op3_secret_scans": secrets.op3_secret_scans,
    "op4_warc_chunks": warc.op4_warc_chunks,
    "op5_multi_index": multiindex.op5_multi_index,
    "op6_quality": quality.op6_quality,
    "op7_decontamination": tiling.op7_decontamination,
    "op8_simhash": simhash.op8_simhash,
    "op9_sentencepiece": spm.op9_sentencepiece,
    "op10_lattice": lattice.op10_lattice,
    "op11_conversation_repair": repair.op11_conversation_repair,
    "op12_byte_bpe": bpe.op12_byte_bpe,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE_SQL: dict[str, str] = {"op3_secret_scans": secrets.OP3_SQL, "op4_warc_chunks": warc.OP4_SQL}
