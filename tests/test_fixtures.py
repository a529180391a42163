"""The nested inputs built from the driver's tables keep every group bounded."""

from pyspark.sql import functions as F

from storylens.operators.flatten import story_links
from storylens.operators.unwrap import reels_from_raw
from storylens.plans import fixtures as fx


def _max(df, col):
    return df.agg(F.max(col)).first()[0]


def test_event_documents_are_bounded_even_for_a_hot_user(spark, sf_dir):
    ev = fx.load(spark, "/root/testdata/sf0.01", "events") \
        .withColumn("user_id", F.expr("CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END"))
    reels = fx.event_reels(ev)
    per_doc = reels.select(F.aggregate(F.transform("reel.items", lambda i: F.size(i["story_link_stickers"])),
                                       F.lit(0), lambda a, b: a + b).alias("n"))
    assert _max(per_doc, "n") <= fx.BLOCK
    # every event is in exactly one document
    assert per_doc.agg(F.sum("n")).first()[0] == ev.count()


def test_order_items_and_documents_are_bounded(spark, sf_dir):
    reels = fx.order_reels(fx.load(spark, sf_dir, "orders"), fx.load(spark, sf_dir, "lineitem"))
    items = reels.select(F.explode("items").alias("i"))
    assert _max(items.select(F.size("i.story_link_stickers").alias("n")), "n") <= fx.CHUNK
    assert _max(reels.select(F.size("items").alias("n")), "n") <= fx.BLOCK * fx.CHUNK


def test_lineitem_documents_cover_every_line(spark, sf_dir):
    li = fx.load(spark, sf_dir, "lineitem")
    links = story_links(reels_from_raw(fx.lineitem_raw_documents(li)))
    assert links.count() == li.count()
