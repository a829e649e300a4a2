"""Categories beyond those of the usual pages become columns of the subscription and silver queries."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.plans import catalog


def test_new_categories_are_kept(spark, monkeypatch):
    plain = catalog.listing_pages
    usual = catalog.x17_x18_subscription(spark, SF_SMALL).columns

    def pages(spark, sf_dir):
        new = F.replace("html", F.lit("QIB (Ex Anchor)"), F.lit("QIB"))
        return plain(spark, sf_dir).withColumn("html", F.when(F.crc32("company") % 2 == 0, new).otherwise(F.col("html")))

    monkeypatch.setattr(catalog, "listing_pages", pages)
    sub = catalog.x17_x18_subscription(spark, SF_SMALL)
    added = {"subscription_qib", "allocation_qib"}
    assert set(sub.columns) == set(usual) | added
    got = sub.select(*[F.count(c).alias(c) for c in ["subscription_qib", "allocation_qib", "subscription_qib_ex_anchor"]]).first()
    assert min(got) > 0
    assert added <= set(catalog.s14_silver(spark, SF_SMALL).columns)
