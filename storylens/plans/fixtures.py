"""Inputs derived from the driver's tables (documents, exports, logs, pages, rosters).

No sample documents come with the pipeline, so every nested input is built by Spark
from a base table and grows with it. Grouping keys always include an id
range (``… div BLOCK``) so a document never holds more than ``BLOCK`` source
rows, however skewed the user column is. The oracles in ``oracle.py``
compute the flat answers from the same base tables without nesting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storylens.functions.jsonpath import STORY_MARKER
from storylens.operators.lookup import ORIGIN_RULES_12, ORIGIN_RULES_17
from storylens.operators.roster import DEFAULT_NETWORK
from storylens.plans.attribution import NO_STORY_SENTENCE

RUN_DATE = "2026-12-01"
BLOCK = 1024          # source rows per document at most
STORIES = 11          # stories per document (item key = id % STORIES)
CHUNK = 64            # lines of one order per story item at most

_REDIRECT_HEAD = "https://l.example/?u=https%3A%2F%2F"


def _redirect(host: str) -> tuple[str, str]:
    return (_REDIRECT_HEAD + host + "%2Fp%2F", "&e=1")


# Sticker links: url = prefix || id || suffix, picked by id % len(LINKS).
# Hosts cover every rule, `www.` variants and the edge cases of the host rule.
LINKS: list[tuple[str | None, str | None]] = [
    *(_redirect(("www." if i % 5 == 1 else "") + host) for i, (host, _) in enumerate(ORIGIN_RULES_17)),
    _redirect("WWW.google.com"),                       # upper-case www is kept: no label
    _redirect("shop.unknown.example"),                 # unknown host
    (_REDIRECT_HEAD + "amzlink.to&e=", ""),            # no path: host keeps the tail
    ("https://l.example/?u=https%3a%2f%2famzlink.to%2fp%2f", ""),  # lower-case escapes
    ("https://amzlink.to/p/", ""),                     # no u=
    (None, None),                                      # NULL url
    _redirect("www.google.www.com"),                   # every www. removed
]

# Display urls of provider exports: display_url = prefix || id; None = NULL story_link.
DISPLAY_LINKS: list[str | None] = [
    *(f"{host}/p/" for host, _ in ORIGIN_RULES_12),
    *(f"{host}/p/" for host in ("www." + ORIGIN_RULES_12[0][0], "shop.unknown.example")),  # without a rule
    None,
]

# Envelope around the reels list, shaped like the captured page data so that the
# deep path resolves. ``{feed}`` is the feed key.
ENVELOPE_HEAD = ('{{"require":[["ScheduledServerJS","handle",null,[{{"__bbox":{{"require":'
                 '[["RelayPrefetchedStreamCache","next",[],["adp_key",{{"__bbox":{{"result":'
                 '{{"data":{{"{feed}":{{"reels_media":')
ENVELOPE_TAIL = "}}}}}]]]}}]]]}"
# Broken shapes, picked by (user + block) % 7 in the raw-document fixture.
BROKEN_INDEX = '{"require":[["ScheduledServerJS","handle",null,[{"__bbox":{"require":[["x","y","z",["adp_key"]]]}}]]]}'
BROKEN_NULL = '{"require":[["ScheduledServerJS","handle",null,[{"__bbox":null}]]]}'


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list, idx: Column) -> Column:
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (idx % F.lit(len(values))).cast("int") + 1)


def link_url(id_col: Column, pick_col: Column | None = None) -> Column:
    """Sticker url for a row: LINKS[pick % n] around ``id``."""
    pick = id_col if pick_col is None else pick_col
    prefix = _pick([p for p, _ in LINKS], pick)
    suffix = _pick([s for _, s in LINKS], pick)
    return F.concat(prefix, id_col.cast("string"), suffix)


def display_url(id_col: Column) -> Column:
    return F.concat(_pick(DISPLAY_LINKS, id_col), id_col.cast("string"))


def envelope(reels_json: Column, feed: str = STORY_MARKER) -> Column:
    return F.concat(F.lit(ENVELOPE_HEAD.format(feed=feed)), reels_json, F.lit(ENVELOPE_TAIL))


def events_username(user_id: Column) -> Column:
    """Usernames of event users; every 50th user (id % 50 = 7) has none."""
    return F.when(user_id % 50 != 7, F.concat(F.lit("u"), user_id.cast("string")))


# --- nesting -----------------------------------------------------------------

def nest_reels(flat: DataFrame, doc_keys: list[str], item_key: str, order_col: str,
               link: Column) -> DataFrame:
    """Nest flat sticker rows into one reel per document.

    ``flat`` has ``username`` plus the key columns; ``link`` is the
    ``story_link`` struct of a row (NULL allowed). Output: ``doc_keys``,
    ``seq`` (smallest order value), ``reel struct<user, items>``.
    """
    stick = flat.groupBy(*doc_keys, "username", item_key).agg(
        F.min(order_col).alias("__first"),
        F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("o"),
                                             link.alias("story_link")))).alias("__s"))
    stick = stick.withColumn("__stickers", F.transform(
        "__s", lambda s: F.struct(s.getField("story_link").alias("story_link"))))
    items = stick.groupBy(*doc_keys, "username").agg(
        F.min("__first").alias("seq"),
        F.sort_array(F.collect_list(F.struct(F.col(item_key).alias("k"),
                                             F.col("__stickers").alias("s")))).alias("__i"))
    return items.select(
        *doc_keys, "seq",
        F.struct(F.struct(F.col("username").alias("username")).alias("user"),
                 F.transform("__i", lambda i: F.struct(
                     i.getField("s").alias("story_link_stickers"))).alias("items")).alias("reel"))


def event_reels(events: DataFrame) -> DataFrame:
    """Reels from ``events``: one document per (user, id block), story = id % 11."""
    flat = events.select(
        "user_id", "event_id",
        F.expr(f"event_id div {BLOCK}").alias("block"),
        events_username(F.col("user_id")).alias("username"),
        (F.col("event_id") % STORIES).alias("story"),
        link_url(F.col("event_id")).alias("url"))
    return nest_reels(flat, ["user_id", "block"], "story", "event_id",
                      F.struct(F.col("url").alias("url")))


def broken_kind(user_id: Column, block: Column) -> Column:
    return ((user_id + block) % 7).cast("int")


def raw_documents(events: DataFrame, broken: bool = True) -> DataFrame:
    """Raw captured documents (run_date, username, seq, doc) from ``events``.

    With ``broken``: kind 1 misses a key, 2 has an index out of range, 3 a NULL
    on the path, 4 is already unwrapped (a list), 5 is truncated JSON.
    """
    reels = event_reels(events)
    reels_json = F.to_json(F.array(F.col("reel")))
    good = envelope(reels_json)
    doc = good
    if broken:
        kind = broken_kind(F.col("user_id"), F.col("block"))
        doc = (F.when(kind == 1, envelope(reels_json, "xdt_api__v1__feed__other"))
               .when(kind == 2, F.lit(BROKEN_INDEX))
               .when(kind == 3, F.lit(BROKEN_NULL))
               .when(kind == 4, reels_json)
               .when(kind == 5, F.substring(good, 1, 60))
               .otherwise(good))
    return reels.select(F.lit(RUN_DATE).cast("date").alias("run_date"),
                        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("username"),
                        F.col("seq").cast("bigint").alias("seq"),
                        doc.alias("doc"))


def strict_documents(raw: DataFrame) -> DataFrame:
    """Raw documents with further shapes by seq % 13: 1 a number in the list's place, 2 text
    behind the value, 3 valid with repeated keys."""
    k = F.col("seq") % 13
    lone = ENVELOPE_HEAD.format(feed=STORY_MARKER) + '[{"user":{"username":"x"},"items":[]}]' + ENVELOPE_TAIL
    doc = (F.when(k == 1, F.lit(ENVELOPE_HEAD.format(feed=STORY_MARKER) + "5" + ENVELOPE_TAIL))
           .when(k == 2, F.concat("doc", F.lit(" oops")))
           .when(k == 3, F.lit(lone[:-1] + ',"k":1,"k":2}')).otherwise(F.col("doc")))
    return raw.withColumn("doc", doc)


def lineitem_raw_documents(lineitem: DataFrame, block: int = 65536) -> DataFrame:
    """Bench documents: user = supplier, story = order, one sticker per line."""
    flat = lineitem.select(
        F.col("l_suppkey").alias("user_id"),
        F.expr(f"l_orderkey div {block}").alias("block"),
        F.expr(f"l_linenumber div {CHUNK * CHUNK}").alias("chb"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("username"),
        F.struct("l_orderkey", F.expr(f"l_linenumber div {CHUNK}")).alias("story"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("o"),
        link_url(F.col("l_orderkey"), F.col("l_partkey")).alias("url"))
    reels = nest_reels(flat, ["user_id", "block", "chb"], "story", "o",
                       F.struct(F.col("url").alias("url")))
    return reels.select(F.lit(RUN_DATE).cast("date").alias("run_date"),
                        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("username"),
                        F.col("seq").cast("bigint").alias("seq"),
                        envelope(F.to_json(F.array(F.col("reel")))).alias("doc"))


def order_reels(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Reels from orders/lineitem: user = customer, story = order, sticker = line.

    Orders with key % 13 = 0 have a NULL sticker list, % 17 = 0 an empty one;
    line 2 of orders with key % 5 = 0 has a NULL story_link. An order's lines
    are cut into items of at most ``CHUNK`` lines, and a document holds at
    most ``BLOCK`` orders and ``CHUNK`` chunks of each, so no group is unbounded.
    """
    lines = lineitem.select(
        "l_orderkey", F.expr(f"l_linenumber div {CHUNK}").alias("ch"),
        F.struct(F.col("l_linenumber").alias("o"),
                 F.when((F.col("l_linenumber") == 2) & (F.col("l_orderkey") % 5 == 0), F.lit(None))
                  .otherwise(F.struct(link_url(F.col("l_orderkey"), F.col("l_partkey")).alias("url")))
                  .alias("story_link")).alias("st"))
    per_chunk = lines.groupBy("l_orderkey", "ch").agg(F.sort_array(F.collect_list("st")).alias("__s"))
    special = (F.col("o_orderkey") % 13 == 0) | (F.col("o_orderkey") % 17 == 0)
    o = orders.select("o_orderkey", "o_custkey")
    normal = o.filter(~special).join(per_chunk, o["o_orderkey"] == per_chunk["l_orderkey"], "left") \
        .select("o_orderkey", "o_custkey", F.coalesce("ch", F.lit(0)).alias("ch"), "__s")
    sticker_type = "array<struct<story_link:struct<url:string>>>"
    empty = F.array().cast(sticker_type)
    flagged = o.filter(special).select("o_orderkey", "o_custkey", F.lit(0).cast("int").alias("ch"),
                                       F.lit(None).cast(per_chunk.schema["__s"].dataType).alias("__s"))
    stickers = F.coalesce(F.transform(
        "__s", lambda s: F.struct(s.getField("story_link").alias("story_link"))), empty)
    stickers = (F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast(sticker_type))
                .when(F.col("o_orderkey") % 17 == 0, empty).otherwise(stickers))
    items = normal.unionByName(flagged).select(
        "o_custkey", F.expr(f"o_orderkey div {BLOCK}").alias("block"),
        F.expr(f"ch div {CHUNK}").alias("chb"),
        F.struct(F.col("o_orderkey").alias("k"), F.col("ch").alias("c"),
                 stickers.alias("story_link_stickers")).alias("it"))
    docs = items.groupBy("o_custkey", "block", "chb").agg(F.sort_array(F.collect_list("it")).alias("__i"))
    return docs.select(
        F.struct(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("username")).alias("user"),
        F.transform("__i", lambda i: F.struct(
            i.getField("story_link_stickers").alias("story_link_stickers"))).alias("items"))


def export_items(events: DataFrame) -> DataFrame:
    """Provider export items (item_id, requested, stories) from ``events``.

    One item per (user, id block); users with id % 9 = 4 hold the no-story
    sentence; users with id % 40 = 3 have no ``requested``.
    """
    return _export_items(events.select(
        "user_id", F.expr(f"event_id div {BLOCK}").alias("block"),
        (F.col("event_id") % STORIES).alias("story"), F.col("event_id").alias("o"),
        display_url(F.col("event_id")).alias("display_url")), "u")


def lineitem_export_items(lineitem: DataFrame, block: int = 65536) -> DataFrame:
    """Bench export items: user = supplier, story = order, one sticker per line."""
    return _export_items(lineitem.select(
        F.col("l_suppkey").alias("user_id"),
        (F.expr(f"l_orderkey div {block}") * 1024 + F.expr(f"l_linenumber div {CHUNK * CHUNK}")).alias("block"),
        F.struct("l_orderkey", F.expr(f"l_linenumber div {CHUNK}")).alias("story"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("o"),
        display_url(F.col("l_partkey")).alias("display_url")), "s")


def _export_items(flat: DataFrame, prefix: str) -> DataFrame:
    link = F.when(F.col("display_url").isNotNull(),
                  F.struct(F.col("display_url").alias("display_url")))
    reels = nest_reels(flat.withColumn("username", F.lit("")), ["user_id", "block"], "story", "o", link)
    stories = F.when(F.col("user_id") % 9 == 4, F.lit(NO_STORY_SENTENCE)) \
        .otherwise(F.to_json(F.col("reel.items")))
    requested = F.when(F.col("user_id") % 40 != 3,
                       F.concat(F.lit(prefix), F.col("user_id").cast("string")))
    return reels.select(F.col("seq").alias("item_id"), requested.alias("requested"),
                        stories.alias("stories"))


def capture_log_from_events(events: DataFrame) -> DataFrame:
    """Browser log (username, seq, message): one entry per event.

    signup -> another method; error -> malformed JSON; url by id % 5: 0 the
    profile endpoint, 1 a longer name ending in it (substring match), 2-4 no match.
    """
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    k = F.col("event_id") % 5
    url = (F.when(k == 0, F.concat(F.lit("https://social.example/stories/"), user, F.lit("/?r="),
                                   F.col("event_id").cast("string")))
           .when(k == 1, F.concat(F.lit("https://cdn.example/jo"), user, F.lit("/?r=1")))
           .when(k == 2, F.concat(F.lit("https://social.example/"), user, F.lit("/")))
           .when(k == 4, F.lit("https://social.example/stories/other/?r=1")))
    return _log_entries(events.select(
        user.alias("username"), F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "signup", F.lit("Network.requestWillBeSent"))
         .otherwise(F.lit("Network.responseReceived")).alias("method"),
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("request_id"),
        url.alias("url"), (F.col("event_type") == "error").alias("malformed")))


def _log_entries(rows: DataFrame) -> DataFrame:
    msg = F.to_json(F.struct(F.struct(
        F.col("method").alias("method"),
        F.struct(F.col("request_id").alias("requestId"),
                 F.struct(F.col("url").alias("url")).alias("response")).alias("params")
    ).alias("message")))
    msg = F.when(F.col("malformed"), F.substring(msg, 1, 30)).otherwise(msg)
    return rows.select("username", F.col("seq").cast("bigint").alias("seq"), msg.alias("message"))


def profile_page(username: Column, seq: Column) -> Column:
    """A page whose embedded block carries one reel for ``username``."""
    reel = F.struct(F.struct(username.alias("username")).alias("user"),
                    F.array(F.struct(F.array(F.struct(F.struct(
                        link_url(seq).alias("url")).alias("story_link"))).alias("story_link_stickers")))
                    .alias("items"))
    doc = envelope(F.to_json(F.array(reel)))
    return F.concat(F.lit('<html><head><script type="application/json" data-sjs>'), doc,
                    F.lit("</script></head><body></body></html>"))


def capture_inputs(customer: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(profiles, log, bodies, page_errors) for the capture-outcome query.

    Orders are log entries of their customer; key % 3 = 0 does not match.
    Body by key % 7: 0 none, 1 undecodable base64, 2 page without JSON,
    3 base64 page with JSON, else plain page with JSON.
    Customers with key % 97 = 0 had a page error.
    """
    user = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    profiles = customer.select(user.alias("username"))
    page_errors = customer.filter(F.col("c_custkey") % 97 == 0).select(user.alias("username"))
    ouser = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    key = F.col("o_orderkey")
    url = F.when(key % 3 != 0, F.concat(F.lit("https://social.example/stories/"), ouser,
                                        F.lit("/?r="), key.cast("string"))) \
        .otherwise(F.lit("https://social.example/explore/"))
    log = _log_entries(orders.select(
        ouser.alias("username"), key.alias("seq"), F.lit("Network.responseReceived").alias("method"),
        F.concat(F.lit("q"), key.cast("string")).alias("request_id"), url.alias("url"),
        F.lit(False).alias("malformed")))
    kind = key % 7
    page = profile_page(ouser, key)
    body = (F.when(kind == 1, F.lit("a"))
            .when(kind == 2, F.concat(F.lit("<html><body>order "), key.cast("string"), F.lit("</body></html>")))
            .when(kind == 3, F.base64(F.encode(page, "UTF-8")))
            .otherwise(page))
    bodies = orders.filter((key % 3 != 0) & (kind != 0)).select(
        ouser.alias("username"), F.concat(F.lit("q"), key.cast("string")).alias("request_id"),
        body.alias("body"), kind.isin(1, 3).alias("base64_encoded"))
    return profiles, log, bodies, page_errors


def document_bodies(documents: DataFrame) -> DataFrame:
    """Bodies from ``documents.text``: id % 3 = 0 plain, else base64 (id % 3 = 2 with line breaks)."""
    b64 = F.base64(F.encode("text", "UTF-8"))
    k = F.col("doc_id") % 3
    body = (F.when(k == 0, F.col("text"))
            .when(k == 1, b64)
            .otherwise(F.regexp_replace(b64, "(.{76})", "$1\n")))
    return documents.select(F.col("source").alias("username"),
                            F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("request_id"),
                            body.alias("body"), (k != 0).alias("base64_encoded"))


# Fixed page blocks for the embedded-JSON fixture (page_id % 10 picks the case).
_SJS = '<script type="application/json" data-sjs>'
_END = "</script>"


def story_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with a synthetic block sequence put in front of the html."""
    pid = F.col("page_id")
    user = F.concat(F.lit("p"), pid.cast("string"))
    reel = F.struct(F.struct(user.alias("username")).alias("user"),
                    F.array(F.struct(F.array(F.struct(F.struct(
                        link_url(pid).alias("url")).alias("story_link"))).alias("story_link_stickers")))
                    .alias("items"))
    good = envelope(F.to_json(F.array(reel)))
    marked_no_require = F.lit('{"other":"' + STORY_MARKER + '"}')
    bad = F.lit('{"require": [' + STORY_MARKER)
    k = pid % 10
    blk = lambda body: F.concat(F.lit(_SJS), body, F.lit(_END))
    prefix = (F.when(k == 0, F.lit(""))
              .when(k == 1, blk(F.lit('{"require":[1]}')))
              .when(k == 2, blk(marked_no_require))
              .when(k == 3, F.concat(blk(F.lit('{"require":[2]}')), blk(good)))
              .when(k == 4, F.concat(blk(marked_no_require), blk(good)))
              .when(k == 5, F.concat(blk(bad), blk(good)))
              .when(k == 6, F.concat(blk(good), blk(bad)))
              .when(k == 7, blk(F.concat(F.lit("\n"), F.replace(good, F.lit(',"items"'), F.lit(',\n"items"')),
                                         F.lit("\n"))))
              .when(k == 8, F.concat(F.lit('<script data-sjs type="application/json">'), good, F.lit(_END)))
              .otherwise(blk(F.lit('{"require":null,"k":"' + STORY_MARKER + '"}'))))
    return pages.select("page_id", "url", F.concat(prefix, F.col("html")).alias("html"))


def roster_a(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.concat(F.lit("https://social.example/"), F.col("c_name"), F.lit("/")).alias("LINK"),
        "c_custkey", "c_mktsegment")


def roster_b(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey") % 4
    rede = (F.when(k == 0, F.lit(DEFAULT_NETWORK)).when(k == 1, F.lower(F.lit(DEFAULT_NETWORK)))
            .when(k == 3, F.lit("TikTok")))
    return supplier.select(
        F.concat(F.lit("https://social.example/"), F.col("s_name"), F.lit("/")).alias("LINK"),
        rede.alias("Rede"), F.col("s_nationkey").alias("note_b"))


def shortened_links(pages: DataFrame) -> DataFrame:
    """Page urls as roster links; every 7th is cut to scheme and host."""
    short = F.concat(F.split_part("url", F.lit("/"), F.lit(1)), F.lit("//"),
                     F.split_part("url", F.lit("/"), F.lit(3)))
    return pages.select("page_id", F.when(F.col("page_id") % 7 == 0, short)
                        .otherwise(F.col("url")).alias("LINK"))
