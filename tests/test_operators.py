"""Edge rows for operators (FIXTURES.md §2): flatten, lookup, dedup, unwrap, pages, capture."""

import json

from pyspark.sql import functions as F

from storylens.functions.jsonpath import STORY_MARKER
from storylens.operators import capture as cap
from storylens.operators.flatten import explode_items, story_links
from storylens.operators.lookup import ORIGIN_RULES_12, ORIGIN_RULES_17, label_hosts, rules_frame
from storylens.operators.pages import page_documents
from storylens.operators.roster import prepare_roster, profile_count
from storylens.operators.unwrap import quarantine, reels_from_raw, reels_rows, unwrap
from storylens.plans import fixtures as fx
from storylens.plans.attribution import attribution_rows, daily_attribution, export_reels, link_attribution
from storylens.schemas import REEL

RED = "https://l.example/?u=https%3A%2F%2F{}%2Fp&e=1"


def _reels(spark, rows):
    return spark.createDataFrame([json.dumps(r) for r in rows], "string") \
        .select(F.from_json("value", REEL).alias("r")).select("r.user", "r.items")


def _reel(user, *items):
    return {"user": {"username": user} if user is not None else None, "items": list(items)}


def _item(*urls):
    return {"story_link_stickers": [{"story_link": None if u is None else {"url": u}} for u in urls]}


def test_flatten_null_and_empty_lists(spark):
    reels = _reels(spark, [
        {"user": {"username": "a"}, "items": None},
        {"user": {"username": "b"}, "items": []},
        {"user": {"username": "c"}, "items": [{"story_link_stickers": None}, {}, {"story_link_stickers": []}]},
        _reel("d", _item(None)),
        _reel("e", _item("x", "y")),
        {"require": [1]},
    ])
    rows = sorted((r.username, r.story_link_url) for r in story_links(reels).collect())
    assert rows == [("d", None), ("e", "x"), ("e", "y")]
    assert explode_items(reels).count() == 5


def test_lookup_filter_dedup(spark):
    amz, ml = RED.format("amzlink.to"), RED.format("mercadolivre.com")
    reels = _reels(spark, [
        _reel("a", _item(amz, amz)),
        _reel("a", _item(ml, RED.format("www.mercadolivre.com.br"))),
        _reel("b", _item(RED.format("unknown.example"), None)),
        _reel(None, _item(amz)),
    ])
    q2 = attribution_rows(reels, "2026-12-01").collect()
    assert len(q2) == 7
    assert sum(r.origin is None for r in q2) == 2
    q1 = sorted(((r.username or ""), r.origin) for r in daily_attribution(reels, "2026-12-01").collect())
    assert q1 == [("", "Amazon"), ("a", "Amazon"), ("a", "Mercado Livre")]
    # U2 idempotent, Q1 = distinct(Q2 with P3)
    d = daily_attribution(reels, "2026-12-01")
    assert d.distinct().exceptAll(d).count() == 0
    q2f = attribution_rows(reels, "2026-12-01").filter("origin is not null").distinct()
    assert q2f.exceptAll(d).count() == 0 and d.exceptAll(q2f).count() == 0
    # the same rules as a DataFrame go through the join path: same rows
    dj = daily_attribution(reels, "2026-12-01", rules_frame(spark))
    assert dj.exceptAll(d).count() == 0 and d.exceptAll(dj).count() == 0
    q2j = attribution_rows(reels, "2026-12-01", rules_frame(spark))
    assert q2j.exceptAll(attribution_rows(reels, "2026-12-01")).count() == 0


def test_rules_are_disjoint_and_broadcast(spark):
    assert len({h for h, _ in ORIGIN_RULES_17}) == 17
    assert len({h for h, _ in ORIGIN_RULES_12}) == 12
    assert {o for _, o in ORIGIN_RULES_17} >= {o for _, o in ORIGIN_RULES_12}
    df = spark.createDataFrame([("amzlink.to",), ("nope",), (None,)], "host string")
    out = label_hosts(df, "host")
    assert sorted((r.host or "", r.origin or "") for r in out.collect()) == [
        ("", ""), ("amzlink.to", "Amazon"), ("nope", "")]
    # a rule table given as a DataFrame is a checked broadcast join, same answer
    rdf = rules_frame(spark, ORIGIN_RULES_17)
    joined = label_hosts(df, "host", rdf)
    assert sorted((r.host or "", r.origin or "") for r in joined.collect()) == [
        ("", ""), ("amzlink.to", "Amazon"), ("nope", "")]
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert label_hosts(df, "host", rdf, keep_unmatched=False).count() == 1
    # a large in-code rule set is joined too
    many = list(ORIGIN_RULES_17) + [(f"h{i}.example", "X") for i in range(100)]
    assert label_hosts(df, "host", many).filter("origin = 'Amazon'").count() == 1


def _env(reels_json, feed=STORY_MARKER):
    return fx.ENVELOPE_HEAD.format(feed=feed) + reels_json + fx.ENVELOPE_TAIL


def test_unwrap_paths_and_quarantine(spark):
    reel = json.dumps([_reel("a", _item(RED.format("amzlink.to")))])
    raw = spark.createDataFrame([
        (1, _env(reel)), (2, _env(reel, "other_feed")), (3, fx.BROKEN_INDEX), (4, fx.BROKEN_NULL),
        (5, reel), (6, _env(reel)[:50]), (7, None), (8, '{"a": 1}'),
    ], "seq long, doc string")
    status = {r.seq: r.unwrap_status for r in unwrap(raw).collect()}
    assert status == {1: "ok", 2: "path_not_found", 3: "path_not_found", 4: "path_not_found",
                      5: "ok", 6: "not_json", 7: "not_json", 8: "path_not_found"}
    assert reels_rows(unwrap(raw), keep=("seq",)).count() == 2
    assert reels_from_raw(raw, keep=("seq",)).count() == 2
    assert quarantine(unwrap(raw), keep=("seq",)).count() == 6


def _page(*blocks):
    return "".join(blocks) + "<html><body>x</body></html>"


def _sjs(body, attrs='type="application/json" data-sjs'):
    return f"<script {attrs}>{body}</script>"


def test_embedded_json_cases(spark):
    good = _env(json.dumps([_reel("p", _item("u"))]))
    no_req = json.dumps({"other": STORY_MARKER})
    bad = '{"require": [' + STORY_MARKER
    cases = [
        (_page(), False),
        (_page(_sjs('{"require":[1]}')), False),
        (_page(_sjs(no_req)), False),
        (_page(_sjs('{"require":[2]}'), _sjs(good)), True),
        (_page(_sjs(no_req), _sjs(good)), True),
        (_page(_sjs(bad), _sjs(good)), False),
        (_page(_sjs(good), _sjs(bad)), True),
        (_page(_sjs("\n" + good.replace(",", ",\n") + "\n")), True),
        (_page(_sjs(good, 'data-sjs type="application/json"')), False),
        (_page(_sjs('{"require":null,"k":"' + STORY_MARKER + '"}')), False),
        (_page(_sjs(good, 'type="application/json" nonce="x" data-sjs="1"')), True),
    ]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(cases)], "page_id long, html string")
    got = {r.page_id: r.doc for r in page_documents(df).collect()}
    for i, (_, found) in enumerate(cases):
        assert (got[i] is not None) == found, i
        if found:
            assert json.loads(got[i])["require"] == json.loads(good)["require"]


def _log(username, seq, url, method=cap.RESPONSE_RECEIVED, rid=None):
    msg = {"message": {"method": method, "params": {"requestId": rid or f"r{seq}", "response": {"url": url}}}}
    return (username, seq, json.dumps(msg))


def test_capture_outcomes(spark):
    import base64
    ok_page = _page(_sjs(_env(json.dumps([_reel("x", _item("u"))]))))
    profiles = spark.createDataFrame([(u,) for u in "a b c d e f g h a".split()], "username string")
    log = spark.createDataFrame([
        ("a", 1, "{not json"), _log("a", 2, "https://i/a/?r=1"), _log("a", 3, "https://i/a/?r=2"),
        _log("b", 1, "https://i/b/?r=1", method="Network.requestWillBeSent"),
        _log("c", 1, "https://i/c/?r=1"),
        _log("d", 1, "https://i/d/?r=1"),
        _log("e", 1, "https://i/e/?r=1"),
        _log("f", 1, "https://i/f/?r=1"),
        _log("g", 1, "https://i/jog/?r=1"),
    ], "username string, seq long, message string")
    bodies = spark.createDataFrame([
        ("a", "r2", ok_page, False), ("a", "r3", "<html/>", False),
        ("d", "r1", "a", True),
        ("e", "r1", base64.b64encode(ok_page.encode()).decode().rstrip("="), True),
        ("f", "r1", "<html>nothing</html>", False),
        ("g", "r1", ok_page, False),
    ], "username string, request_id string, body string, base64_encoded boolean")
    errors = spark.createDataFrame([("h",)], "username string")
    out = cap.capture_outcomes(profiles, log, bodies, errors)
    got = sorted((r.username, r.status) for r in out.collect())
    assert got == [("a", "captured"), ("a", "captured"), ("b", "not_available"), ("c", "body_error"),
                   ("d", "body_error"), ("e", "captured"), ("f", "payload_not_found"),
                   ("g", "captured"), ("h", "page_error")]
    exact = {r.username: r.status for r in cap.capture_outcomes(profiles, log, bodies, exact=True).collect()}
    assert exact["g"] == "not_available"
    summary = cap.capture_outcomes(profiles, log, bodies, errors).transform(
        lambda d: d.agg(F.count_if(F.col("status") == "captured").alias("c"), F.count("*").alias("n"))).first()
    assert (summary.c, summary.n) == (4, 9)
    latest = cap.latest_success(out).collect()
    assert {r.username: r.seq for r in latest} == {"a": 2, "e": 1, "g": 1}


def test_export_items_routes_and_default_key(spark):
    stories = json.dumps([{"story_link_stickers": [{"story_link": {"display_url": "amzlink.to/x"}},
                                                   {"story_link": {"display_url": "www.amzlink.to/x"}}]}])
    items = spark.createDataFrame([
        ("a", "No story available"), ("b", stories), ("c", "[]"), (None, stories), ("e", None),
    ], "requested string, stories string")
    rows = sorted(((r.username or ""), r.story_link_url, r.origin or "") for r in link_attribution(items).collect())
    assert rows == [("", "amzlink.to/x", "Amazon"), ("", "www.amzlink.to/x", ""),
                    ("b", "amzlink.to/x", "Amazon"), ("b", "www.amzlink.to/x", "")]
    assert export_reels(items).count() == 3


def test_roster_preparation(spark):
    a = spark.createDataFrame([("https://s.example/ana/", "n1"), ("https://s.example", "n2")],
                              "LINK string, note string")
    b = spark.createDataFrame([
        ("https://s.example/ana/", "Instagram", "x"), ("https://s.example/bob/", "instagram", "y"),
        ("https://s.example/cid/", None, "z"), ("https://s.example/dan?x=1", "Instagram", "w"),
    ], "LINK string, Rede string, note_b string")
    profiles, bad = prepare_roster(a, b)
    got = sorted((r.LINK, r.note or "", r.Rede or "") for r in profiles.collect())
    assert got == [("ana", "", "Instagram"), ("ana", "n1", ""), ("dan?x=1", "", "Instagram")]
    assert "note_b" not in profiles.columns
    assert [r.LINK for r in bad.collect()] == ["https://s.example"]
    assert profile_count(profiles).first()[0] == 3


def test_first_match_decides_even_if_its_body_fails(spark):
    ok_page = _page(_sjs(_env(json.dumps([_reel("x", _item("u"))]))))
    profiles = spark.createDataFrame([("a",)], "username string")
    log = spark.createDataFrame([_log("a", 1, "https://i/a/?r=1"), _log("a", 2, "https://i/a/?r=2")],
                                "username string, seq long, message string")
    bodies = spark.createDataFrame([("a", "r2", ok_page, False)],
                                   "username string, request_id string, body string, base64_encoded boolean")
    assert [r.status for r in cap.capture_outcomes(profiles, log, bodies).collect()] == ["body_error"]


def test_latest_documents_last_write_wins(spark):
    from storylens.session import scratch_path
    from storylens.sinks.writers import write_latest_documents
    from storylens.sources.readers import read_raw_documents
    caps = spark.createDataFrame([
        ("a", "captured", 1, "d1"), ("a", "captured", 5, "d5"), ("a", "body_error", 9, None),
        ("b", "payload_not_found", 2, None), ("c", "captured", 3, "d3"),
    ], "username string, status string, seq long, doc string")
    p = scratch_path(spark, "k3")
    write_latest_documents(caps, p, "2026-12-01")
    write_latest_documents(caps.filter("username = 'c'"), p, "2026-12-02")
    t = read_raw_documents(spark, p)
    got = sorted((str(r.run_date), r.username, r.seq, r.doc) for r in t.collect())
    assert got == [("2026-12-01", "a", 5, "d5"), ("2026-12-01", "c", 3, "d3"), ("2026-12-02", "c", 3, "d3")]


def test_capture_outcomes_per_visit_keys(spark):
    ok_page = _page(_sjs(_env(json.dumps([_reel("x", _item("u"))]))))
    profiles = spark.createDataFrame([(1, "a"), (2, "a")], "day int, username string")
    rows = [(d,) + _log("a", s, f"https://i/a/?r={s}") for d, s in ((1, 1), (2, 5), (2, 6))]
    log = spark.createDataFrame(rows, "day int, username string, seq long, message string")
    bodies = spark.createDataFrame([(1, "a", "r1", "<html/>", False), (2, "a", "r5", ok_page, False)],
                                   "day int, username string, request_id string, body string, "
                                   "base64_encoded boolean")
    out = cap.capture_outcomes(profiles, log, bodies, keys=("day", "username"))
    assert sorted((r.day, r.status, r.seq) for r in out.collect()) == [
        (1, "payload_not_found", None), (2, "captured", 5)]


def test_unwrap_fallback_cases_match_text_parse(spark):
    from storylens.functions.jsonpath import unwrap_reels_json
    from storylens.operators.unwrap import reels_col
    from storylens.schemas import REELS
    dup = _env('[{"user":{"username":"a","username":"b"},"items":[]}]')
    lone = _env('{"user":{"username":"c"},"items":[]}')
    normal = _env(json.dumps([_reel("d", _item("u"))]))
    raw = spark.createDataFrame([(1, dup), (2, lone), (3, normal)], "seq long, doc string")
    got = raw.select("seq", reels_col(F.col("doc")).alias("fast"),
                     F.from_json(unwrap_reels_json(F.col("doc")), REELS).alias("text")).collect()
    for r in got:
        assert r.fast == r.text, r.seq
    assert [u.unwrap_status for u in unwrap(raw).orderBy("seq").collect()] == ["ok", "ok", "ok"]


def test_log_prefilter_keeps_escaped_methods(spark):
    escaped = json.dumps({"message": {"method": "Network.responseReceived",
                                      "params": {"requestId": "r9", "response": {"url": "https://i/a/?r=1"}}}},
                         ensure_ascii=False).replace("responseReceived", "response\\u0052eceived")
    assert "responseReceived" not in escaped
    log = spark.createDataFrame([("a", 1, escaped), _log("b", 2, "https://i/b/?r=2")],
                                "username string, seq long, message string")
    got = sorted((r.username, r.request_id) for r in cap.first_matches(log).collect())
    assert got == [("a", "r9"), ("b", "r2")]


def test_first_rule_of_a_repeated_host_counts(spark):
    rules = spark.createDataFrame([(2, "h", "late"), (1, "h", "first"), (3, None, "none"), (4, "k", "K")],
                                  "position long, host string, origin string")
    df = spark.createDataFrame([("h",), ("h",), ("x",), (None,), ("k",)], "host string")
    got = sorted((str(r.host), r.origin) for r in label_hosts(df, "host", rules).collect())
    assert got == [("None", None), ("h", "first"), ("h", "first"), ("k", "K"), ("x", None)]
    assert label_hosts(df, "host", rules.drop("position")).count() == 5


def test_page_blocks_are_strict_and_tolerate_repeated_keys(spark):
    from storylens.functions.jsonpath import STORY_MARKER, embedded_require_document

    block = '<script type="application/json" data-sjs>{}</script>'
    good = '{"require":[["%s"]]}' % STORY_MARKER
    cases = {"plain": (good, True), "junk": (good + " oops", False), "two": (good + good, False),
             "keys": (good[:-1] + ',"k":1,"k":2}', True), "nan": (good[:-1] + ',"k":NaN}', True),
             "closed": (good + "] x", False), "cut": (good[:-1], False)}
    df = spark.createDataFrame([(k, block.replace("{}", v)) for k, (v, _) in cases.items()], "k string, html string")
    got = {r.k: r.doc for r in df.select("k", embedded_require_document("html").alias("doc")).collect()}
    assert got == {k: (good if ok else None) for k, (_, ok) in cases.items()}


def test_repeated_bodies_count_once(spark, sf_dir):
    profiles, log, bodies, errors = fx.capture_inputs(fx.load(spark, sf_dir, "customer"), fx.load(spark, sf_dir, "orders"))
    once = cap.capture_outcomes(profiles, log, bodies, errors)
    twice = cap.capture_outcomes(profiles, log, bodies.unionByName(bodies), errors)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_blocks_that_are_no_objects_do_not_decide(spark):
    """A marked list or text without a ``require`` leaves the choice to the next block, on both paths."""
    from storylens.functions.jsonpath import STORY_MARKER, embedded_require_document
    from storylens.operators.pages import page_reels
    from storylens.plans import fixtures as fx

    good = fx.ENVELOPE_HEAD.format(feed=STORY_MARKER) + '[{"user":{"username":"x"},"items":[]}]' + fx.ENVELOPE_TAIL
    blk = lambda t: f'<script type="application/json" data-sjs>{t}</script>'
    first = {"list": f'[1,"{STORY_MARKER}"]', "text": f'"{STORY_MARKER}"', "null": f'{{"require":null,"a":"{STORY_MARKER}"}}',
             "repeated": f'{{"a":1,"a":"{STORY_MARKER}"}}', "none": ""}
    voids = {"junk": good + " oops", "cut": good[:-3]}
    last = {"nan": good[:-1] + ',"k":NaN}', "keys": good[:-1] + ',"k":1,"k":2}', "text-require": f'{{"require":"{STORY_MARKER}"}}'}
    df = spark.createDataFrame([(k, blk(v) + blk(good)) for k, v in {**first, **voids, **last}.items()], "page_id string, html string")
    got = {r.page_id: r.unwrap_status for r in page_reels(df).collect()}
    assert got == {**dict.fromkeys([*first, "nan", "keys"], "ok"), "text-require": "path_not_found"}
    docs = {r.page_id: r.doc for r in df.select("page_id", embedded_require_document("html").alias("doc")).collect()}
    assert all((docs[k] is None) == (k in voids) for k in docs) and all(docs[k] == good for k in first)
