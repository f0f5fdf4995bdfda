"""The registered queries of this subpackage."""

from __future__ import annotations

from varspan.llm import op01_secrets, op02_repeats, op03_license, op04_decontaminate, op05_url_trust, op06_quality, op07_perspectives, op08_setjoin, op09_packing, op10_media, op11_langid, op12_structure, op13_variants
from varspan.llm.common import table

QUERIES = {
    "op1_secrets": lambda spark, d: op01_secrets.query(table(spark, d, "documents")),
    "op2_repeats": lambda spark, d: op02_repeats.query(table(spark, d, "documents")),
    "op3_license": lambda spark, d: op03_license.query(table(spark, d, "documents")),
    "op4_decontaminate": lambda spark, d: op04_decontaminate.query(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op5_url_trust": lambda spark, d: op05_url_trust.query(table(spark, d, "pages")),
    "op6_quality": lambda spark, d: op06_quality.query(table(spark, d, "documents"), table(spark, d, "labels")),
    "op7_perspectives": lambda spark, d: op07_perspectives.query(table(spark, d, "conversations")),
    "op8_setjoin": lambda spark, d: op08_setjoin.query(table(spark, d, "documents")),
    "op9_packing": lambda spark, d: op09_packing.query(table(spark, d, "documents")),
    "op10_media": lambda spark, d: op10_media.query(table(spark, d, "documents")),
    "op11_langid": lambda spark, d: op11_langid.query(table(spark, d, "documents")),
    "op12_structure": lambda spark, d: op12_structure.query(table(spark, d, "conversations")),
    "op13_variants": lambda spark, d: op13_variants.query(table(spark, d, "documents")),
}
ORACLES: dict[str, str] = {"op7_perspectives": op07_perspectives.ORACLE}
