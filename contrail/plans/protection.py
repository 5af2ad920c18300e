"""Column protection queries: AES round trip, role masks, role row filters, PII tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail.operators import protect as pr
from contrail.operators.joins import dim_join
from contrail.plans.registry import register
from contrail.sources.tables import planes, table, with_views

DEMO_KEY = "1234567890123456"  # 16 characters → AES-128; the lab's example key


@register("crypt_aes_column", with_views("""
SELECT manufacturer, true AS roundtrip_ok, length(manufacturer) > 0 AS has_ciphertext
FROM planes WHERE manufacturer IS NOT NULL GROUP BY manufacturer""", "planes"))
def crypt_aes_column(spark, d):
    """Encrypt each distinct manufacturer (base64 of AES/ECB/PKCS), decrypt again and compare."""
    enc = pr.encrypt_distinct(planes(spark, d), "manufacturer", DEMO_KEY)
    dec = pr.aes_decrypt_b64("description_crypt", DEMO_KEY)
    return enc.select("manufacturer", (dec == F.col("manufacturer")).alias("roundtrip_ok"),
                      (F.length("description_crypt") > 0).alias("has_ciphertext"))


POLICY = pr.Policy(
    masks={"analyst": {"c_name": "hash", "c_acctbal": "null"}},
    row_filters={"europe_analyst": "r_name = 'EUROPE'"},
    denied_tags={"analyst": {"PII"}},
)


@register("mask_columns_by_role", """
SELECT c_custkey, sha256(c_name) AS c_name, c_nationkey, CAST(NULL AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer""")
def mask_columns_by_role(spark, d, role: str = "analyst"):
    return pr.apply_masks(table(spark, d, "customer"), POLICY, role)


@register("row_filter_by_role", """
SELECT c.c_custkey, c.c_name, c.c_nationkey, r.r_name FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name = 'EUROPE'""")
def row_filter_by_role(spark, d, role: str = "europe_analyst"):
    geo = dim_join(table(spark, d, "nation"), table(spark, d, "region"),
                   F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    c = dim_join(table(spark, d, "customer"), geo, F.col("c_nationkey") == F.col("n_nationkey"))
    return pr.apply_row_filter(c, POLICY, role).select("c_custkey", "c_name", "c_nationkey", "r_name")


@register("pii_tag_propagation", """
SELECT c.c_custkey, n.n_name, c.c_acctbal FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def pii_tag_propagation(spark, d, role: str = "analyst"):
    """c_name is tagged PII; a derived table computes from it; the analyst role gets the untagged columns only."""
    cust = pr.tag(table(spark, d, "customer"), {"c_name": {"PII"}})
    nat = table(spark, d, "nation")
    derived = dim_join(cust, nat, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.upper("c_name").alias("name_upper"), "n_name", "c_acctbal")
    return pr.enforce_tags(derived, POLICY, role)
