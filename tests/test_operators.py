import random
from datetime import date
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from tidemark.functions.names import alias_table, name_key
from tidemark.operators import crawl, dedup, events, joins, ranking, state, verify
from tidemark.operators.overlap import copies_span
from tidemark.operators.position import with_position
from tidemark.operators.scoring import assessment
from tidemark.runtime import bounded_sample, salted_join


def test_positions_are_a_total_order(spark):
    df = spark.createDataFrame([(i * 7919 % 1009, i) for i in range(1009)], "k int, v int").repartition(7)
    got = with_position(df, [F.asc("k")], "pos").orderBy("k").collect()
    assert [r.pos for r in got] == list(range(1, 1010))
    assert with_position(df.limit(0), [F.asc("k")]).count() == 0


def test_salted_join_keeps_all_rows_of_hot_keys(spark):
    left = spark.range(30_000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = salted_join(left, right.withColumn("n", F.col("n") * 100), ["k"], "n", F.col("id"))
    assert out.count() == 30_000 and out.select("id").distinct().count() == 30_000


def test_bounded_sample(spark):
    df = spark.range(5000).select("id")
    assert bounded_sample(df, "id", 10_000).count() == 5000
    n = bounded_sample(df, "id", 500).count()
    assert 350 < n <= 500


def test_aliases(spark):
    s = spark.createDataFrame([(2, "The Post", ["TP-1"]), (1, "Post!", ["the post", None]), (3, None, None)], "source_id int, name string, aliases array<string>")
    got = {r.name_key: r.source_id for r in alias_table(s).collect()}
    assert got == {"thepost": 1, "post": 1, "tp1": 2}
    assert spark.range(1).select(name_key(F.lit("  ?! ")).alias("k")).first().k is None


def greedy(members, links):
    near = {frozenset(p) for p in links}
    kept, classes = [], {}
    for i in sorted({i for i, _ in members}):
        mine = {c for j, c in members if j == i and c is not None}
        if not any(c == d or frozenset((c, d)) in near for k in kept for c in mine for d in classes[k]):
            kept.append(i)
            classes[i] = mine
    return kept


def test_greedy_as_the_scan(spark):
    rng = random.Random(3)
    for n in (1, 6, 25):
        members = [(rng.randrange(n), f"c{rng.randrange(n)}") for _ in range(2 * n)] + [(n + 1, None)]
        links = [(f"c{rng.randrange(n)}", f"c{rng.randrange(n)}") for _ in range(n // 2)]
        links = [p for p in links if p[0] != p[1]]
        m, e = spark.createDataFrame(members, "id long, cls string"), spark.createDataFrame(links, "a string, b string")
        assert sorted(r.id for r in dedup.greedy_keep(m, e).collect()) == greedy(members, links)


def test_components(spark):
    pairs = spark.createDataFrame([(i, f"k{i}") for i in range(40)] + [(i + 1, f"k{i}") for i in range(39)] + [(100, "z"), (101, None)], "id long, key string")
    got = {r.id: r.root for r in events.components(pairs).collect()}
    assert {got[i] for i in range(40)} == {0} and got[100] == 100


def test_events_hand_on_their_ids():
    base = {"modified": "", "stage": "outcome", "fingerprint": "", "published": "2024-01-01"}
    a = base | {"id": 1, "url_key": "u1", "event_id": "e1", "name": "River summit 9", "summary": "Ministers agreed a levy on the river today", "fingerprint": "f1"}
    b = a | {"id": 2, "url_key": "u2", "event_id": "e2", "published": "2024-01-05", "fingerprint": "f2"}
    c = b | {"id": 3, "url_key": "u3", "event_id": "e1", "fingerprint": "f3", "summary": "Something else altogether happened"}
    d = a | {"id": 4, "url_key": "u1"}
    out = {r["id"]: r for r in events.pass_through([a, b, c, d])}
    assert out[2]["event_out"] == "e1" and out[2]["duplicate_of"] is None
    assert out[3]["duplicate_of"] is None and out[4]["duplicate_of"] == 1


def test_events_as_a_table(spark):
    rows = [(1, 1, "u", "e", "n 1", "2024-01-01", None, "outcome", "f", "s"), (2, 2, "u", "x", "m 2", "2024-01-02", None, None, None, None), (3, 3, None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "id long, place long, url_key string, event_id string, name string, published string, modified string, stage string, fingerprint string, summary string")
    got = {r.id: r.duplicate_of for r in events.consolidate(df).collect()}
    assert got == {1: None, 2: 1, 3: None}


def test_near_names_are_all_found(spark):
    rng, said = random.Random(5), lambda n: "".join(rng.choices("abcd e", k=n))
    names = []
    for _ in range(60):
        base = said(rng.randrange(1, 70))
        for _ in range(4):
            x = list(base)
            for _ in range(rng.randrange(0, 2 + len(x) // 8)):
                at = rng.randrange(len(x) + 1)
                x[at : at + rng.randrange(2)] = rng.choice(["", "z", "b"])
            names.append("".join(x))
    names = sorted(set(names))
    near = lambda a, b: max(SequenceMatcher(None, a, b).ratio(), SequenceMatcher(None, b, a).ratio()) >= 0.9
    want = {(i, j) for j, b in enumerate(names) for i, a in enumerate(names[:j]) if near(a, b)}
    df = spark.createDataFrame([(i, "2024", n) for i, n in enumerate(names)], "id long, block string, name string")
    assert len(want) > 100 and {(r.a, r.b) for r in events.near_names(df).collect()} == want


def test_events_of_a_year_do_not_meet_by_year_alone(spark, monkeypatch):
    rng = random.Random(3)
    words = ["river levy", "port round", "tax treaty", "seed bank", "heat code", "clinic fund"]
    rows = [(i, rng.randrange(999), rng.choice(["", f"u{i // 3}"]), f"e{rng.randrange(60)}", f"{rng.choice(words)} of the {rng.choice(words)}{rng.choice(['', 's', ' 3'])}", f"2024-01-0{rng.randrange(1, 4)}", "", "outcome", f"f{rng.randrange(9)}", rng.choice(words)) for i in range(90)]
    cols = ["id", "place", "url_key", "event_id", "name", "published", "modified", "stage", "fingerprint", "summary"]
    rows = [(r[0], k, *r[2:]) for k, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "id long, place long, " + ", ".join(f"{c} string" for c in cols[2:]))
    want = {r["id"]: (r["event_out"], r["duplicate_of"]) for r in events.pass_through([dict(zip(cols, r)) for r in rows])}
    assert {r.id: (r.event_out, r.duplicate_of) for r in events.consolidate(df).collect()} == want
    apart = spark.createDataFrame([(i, i, f"u{i}", f"e{i}", n, "2024-01-01", "", "outcome", f"f{i}", n) for i, n in enumerate(words)], df.schema)
    sizes = []
    monkeypatch.setattr(events, "components", lambda pairs, f=events.components: sizes.append(f(pairs)) or sizes[-1])
    events.consolidate(apart).collect()
    assert sizes[0].select("root").distinct().count() == len(words)


def test_unknown_addresses_are_not_the_same():
    base = {"url_key": "", "modified": "", "stage": "outcome", "published": "2024-01-01"}
    a = base | {"id": 1, "event_id": "e1", "name": "River summit", "fingerprint": "f1", "summary": "Ministers agreed a levy"}
    b = base | {"id": 2, "event_id": "e2", "name": "Port round", "fingerprint": "f2", "summary": "A clinic was opened"}
    assert [r["duplicate_of"] for r in events.pass_through([a, b])] == [None, None]


def test_event_pool_is_every_eligible_candidate(spark, duck):
    from conftest import DATA
    from tidemark.plans import registry

    sql = registry.oracle_sql()
    ask = f"""SELECT candidate_id FROM candidates WHERE coalesce(development_stage, '') <> 'scheduled' AND candidate_id IN (SELECT candidate_id FROM ({sql['p_assess']}))
      AND candidate_id IN (SELECT candidate_id FROM ({sql['p_temporal']}) WHERE verdict = 'in_scope') AND candidate_id IN (SELECT candidate_id FROM ({sql['p_evid']}) WHERE evidence = 'supported')
      AND candidate_id NOT IN ({sql['j_prior']})"""
    want = {r[0] for r in duck.execute(ask).fetchall()}
    got = registry.queries()["o_event"](spark, DATA).collect()
    again = {r[0] for r in duck.execute("SELECT c.candidate_id FROM candidates c JOIN history h ON h.url = c.url AND list_contains(h.published_versions, c.content_fingerprint)").fetchall()}
    assert sorted(r.id for r in got) == sorted(want - again) and all(r.event_out for r in got)


def test_near_titles(spark):
    rows = [(1, "g", "Water levy in the north basin"), (2, "g", "the north basin water levy in"), (3, "g", "Water levy in the north basin today"), (4, "g", "Quite another thing"), (5, "h", "Water levy in the north basin"), (6, "g", None), (7, "g", "!")]
    df = spark.createDataFrame(rows, "id long, g string, t string")
    assert {(r.a, r.b) for r in joins.near_titles(df, "id", "t", ["g"], 0.85).collect()} == {(1, 2), (1, 3)}


def test_publisher_of_host(spark):
    reg = spark.createDataFrame([(1, "Org", "org.example"), (2, "Sub", "www.sub.org.example")], "place int, name string, known string")
    df = spark.createDataFrame([(1, "a.b.org.example"), (2, "sub.org.example"), (3, "x.sub.org.example"), (4, "other.example"), (5, None)], "id int, h string")
    got = {r.id: (r.publisher, r.reviewed) for r in joins.publisher_of_host(df, "id", "h", reg).collect()}
    assert got == {1: ("Org", True), 2: ("Sub", True), 3: ("Org", True), 4: ("other.example", False), 5: (None, False)}


def test_caps_with_and_without_filling(spark):
    df = spark.createDataFrame([("a", 5), ("a", 4), ("a", 3), ("b", 1)], "s string, v int")
    order = [F.desc("v")]
    assert [(r.s, r.v) for r in ranking.cap_then_fill(df, "s", order, 4, 2, fill=False).collect()] == [("a", 5), ("a", 4), ("b", 1)]
    assert [(r.s, r.v) for r in ranking.cap_then_fill(df, "s", order, 4, 2).collect()] == [("a", 5), ("a", 4), ("b", 1), ("a", 3)]


def test_diversity_as_the_loop(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice("abc"), rng.randrange(3), date(2024, 1, 1 + i)) for i in range(20)]
    left, counts, expected = list(rows), {}, []
    while left:
        best = max(left, key=lambda r: (r[2], -counts.get(r[1], 0), r[3]))
        left.remove(best)
        counts[best[1]] = counts.get(best[1], 0) + 1
        expected.append(best[0])
    df = spark.createDataFrame(rows, "i int, s string, v int, d date")
    got = ranking.diversity_pool(df, "s", "v", "d", "i", 12).orderBy("editorial_rank").collect()
    assert [r.i for r in got] == expected[:12]


def test_walk(spark):
    links = spark.createDataFrame([("a", "b", 1), ("a", "c", 2), ("a", "d", 3), ("b", "e", 1), ("e", "f", 1), ("b", "a", 2), ("c", None, 1)], "parent string, url string, place int")
    seen, over = crawl.walk(spark.createDataFrame([("a",), (None,)], "url string"), links, depth=2, per_page=2)
    assert {(r.url, r.depth) for r in seen.collect()} == {("a", 0), ("b", 1), ("c", 1), ("e", 2)}
    assert {(r.url, r.reason) for r in over.collect()} == {("d", "links_per_page")}
    kept, late = crawl.walk(spark.createDataFrame([("a",)], "url string"), links, depth=2, budget=2)
    assert {r.url for r in kept.collect()} == {"a", "b"} and late.where("reason = 'budget'").count() == 3


def test_state_round(spark):
    h = spark.createDataFrame([("k1", "e", "f0", "outcome", date(2024, 1, 1), date(2024, 1, 2), ["f0"]), ("old", "e", "f", "s", None, date(2023, 1, 1), [])], "key string, event_id string, fingerprint string, stage string, published date, last_seen date, versions array<string>")
    seen = spark.createDataFrame([("k1", 1, "e", "f1", "outcome", date(2024, 2, 1), None), ("k1", 2, "e", "f2", "outcome", date(2024, 2, 1), date(2024, 2, 2)), ("k2", 3, None, None, None, None, None)], "key string, place int, event_id string, fingerprint string, stage string, published date, modified date")
    out = {r.key: r for r in state.remember(h, seen, F.lit("2024-02-03").cast("date")).collect()}
    assert set(out) == {"k1", "k2"} and out["k1"].fingerprint == "f2" and out["k1"].versions == ["f0"]
    once = state.finalize(h, seen.where("place = 2"))
    assert once.where("key = 'k1'").first().versions == ["f0", "f2"]
    assert state.finalize(once.drop("published_stage"), seen.where("place = 2")).where("key = 'k1'").first().versions == ["f0", "f2"]
    rev = {r.place: (r.changed, r.date_key) for r in state.revision(seen, h).collect()}
    assert rev[2] == (True, date(2024, 2, 2)) and rev[3] == (False, None)


def test_overlap_and_scores(spark):
    df = spark.createDataFrame([("one two three four", "zero One, two three FOUR five six"), ("one two four three", "zero one two three four five six"), (None, "x"), ("", "a b c d e f")], "n string, s string")
    assert [r.c for r in df.select(copies_span("n", "s", 3, 4).alias("c")).collect()] == [True, False, False, False]
    a = df.select(assessment(F.col("s"), F.col("n"), F.lit(True), F.lit(True), F.lit(True)).alias("a")).collect()
    assert {r.a.score for r in a} == {0}


def test_settings_are_checked():
    import pytest

    from tidemark.config import Settings

    assert Settings.of({"pool": 5}).pool == 5
    for bad in ({"pool": 0}, {"nope": 1}, {"rolling_days": -1}, {"pool": True}):
        with pytest.raises(ValueError):
            Settings.of(bad)


def test_batch_models_must_answer_every_text(spark):
    import pytest

    from tidemark.operators import scorers

    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id long, text string")
    assert {r.id: r.text_out for r in scorers.in_batches(df, "id", "text", lambda t: [x.upper() for x in t], 1).collect()} == {1: "A", 2: None, 3: "B"}
    with pytest.raises(Exception, match="every text"):
        scorers.in_batches(df, "id", "text", lambda t: []).collect()


def test_citations_are_confirmed_by_every_fact(spark):
    cited = "id int, doi string, title string, journal string, authors string, year int"
    c = spark.createDataFrame([(1, "d1", "The Levy", "Acta", "Ostrand A., Vell B.", 2020), (2, "d2", "The Levy", "Acta", "Ostrand A.", 2020), (3, None, "T", "J", "A", 2020), (4, "gone", "T", "J", "A", 2020), (5, "d3", "T", None, "A", 2020), (6, "d4", "T", "J", "A", None)], cited)
    w = spark.createDataFrame([("d1", "Other", "ACTA", ["Ostrand"], 2020), ("d1", "the levy!", "ACTA", ["Ostrand", "Vell"], 2020), ("d2", "The levy", "Acta", ["Ostrand", "Vell"], 2020), ("d3", "T", None, ["A"], 2020), ("d4", "T", "J", ["A"], 2020)], "doi string, title string, journal string, families array<string>, year int")
    got = {r.id: (r.verified, r.reason) for r in verify.verify_citations(c, w).collect()}
    assert got == {1: (True, "verified"), 2: (False, "authors"), 3: (False, "no_doi"), 4: (False, "unknown_doi"), 5: (False, "journal"), 6: (False, "year")}
    empty = verify.verify_citations(c.limit(1), w.withColumn("families", F.array().cast("array<string>")))
    assert empty.first().reason == "authors" and verify.verify_citations(c.limit(0), w).count() == 0


def test_budget_keeps_requests_back(spark):
    df = spark.createDataFrame([(k, "h" if k < 40 else "i") for k in range(80)], "id int, host string")
    ids = lambda **k: sorted(r.id for r in crawl.within_budget(df, [F.asc("id")], 50, "host", 30, **k).collect())
    assert ids() == [*range(30), *range(40, 60)] and ids(evidence=12) == [*range(20), *range(40, 58)] and len(ids(evidence=1000)) == 25
