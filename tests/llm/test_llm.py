"""Operators for training data against brute force, exact round trips and held-out accuracy, with the odd cases of each."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import DATA, same_as_sql
from tidemark.llm import boilerplate, capping, history, mixing, registry, residue, spelling, splitting, tokens, truncation
from tidemark.runtime import table

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    if name in SQL:
        same_as_sql(df, duck, SQL[name])
    else:
        rows = df.collect()
        assert len(rows) == len({tuple(map(str, r)) for r in rows})


# --- 1 ---------------------------------------------------------------------------------------


def over(rows):
    groups, out = defaultdict(list), []
    for r in rows:
        if r[0] is not None and r[3] is not None:
            groups[r[0]].append(r)
    for g in groups.values():
        g.sort(key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        out += [r[2] for r in g[max(g[0][3], 0) :]]
    return sorted(out)


def test_capping_as_sorting(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, -5, 0, 3, 2**31 - 1, -(2**31)]), i * 7 - 400, 5) for i in range(200)] + [("d", 1, 10**15, 0), ("e", None, -(10**15), 3), ("f", 1, 5 * 10**9, None)]
    df = spark.createDataFrame(rows, "src string, score int, id long, lim int")
    got = capping.cap_records(df, ["src"], "score", "id", "lim")
    assert sorted(r.id for r in got.where("over_limit").collect()) == over(rows) and got.count() == len(rows)


@pytest.mark.parametrize("kind, scores", [("double", [0.9, 0.95, 0.99, -0.5, -0.75, 0.0, -0.0, 1e300, float("inf"), float("nan"), None]), ("decimal(9,3)", [0.125, 7.5, 12.0, None])])
def test_capping_by_fractions(spark, kind, scores):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice(scores), i * 3 - 100, 7) for i in range(90)]
    df = spark.createDataFrame([(a, None if s is None else str(s), i, c) for a, s, i, c in rows], "src string, score string, id long, lim int").withColumn("score", F.col("score").cast(kind))
    got = capping.cap_records(df, ["src"], "score", "id", "lim")
    want = over([(a, None if s is None or s != s else s, i, c) for a, s, i, c in rows])
    assert sorted(r.id for r in got.where("over_limit").collect()) == want and got.columns == [*df.columns, "over_limit"]


def test_capping_by_share_and_refusals(spark):
    df = spark.createDataFrame([("a", k / 10, k, "x" if k % 2 else "y") for k in range(60)] + [("b", 1.0, 100 + k, "x") for k in range(10)] + [("c", 1.0, 200, None)], "src string, score double, id long, part string")
    capped = capping.cap_records(capping.share_caps(df, 0.5, []), ["src"], "score", "id", "cap")
    assert Counter(r.src for r in capped.where("not over_limit").collect()) == {"a": 35, "b": 10, "c": 1}
    # within parts: 40 records in x, 30 in y; those of no part have no cap
    parts = capping.cap_records(capping.share_caps(df, 0.25, ["part"]), ["part", "src"], "score", "id", "cap")
    assert Counter((r.part, r.src) for r in parts.where("not over_limit").collect()) == {("x", "a"): 10, ("x", "b"): 10, ("y", "a"): 7, (None, "c"): 1}
    with pytest.raises(ValueError):
        capping.cap_records(df.withColumn("lim", F.lit(1)), ["src"], "score", "src", "lim")
    with pytest.raises(ValueError):
        capping.cap_records(df.withColumn("lim", F.lit(1)), ["src"], "part", "id", "lim")


def test_capping_odd_cases(spark):
    empty = spark.createDataFrame([], "src string, score int, id long, lim int, _cut_hi string, _g0 int")
    assert capping.cap_records(empty, ["src"], "score", "id", "lim").count() == 0
    same = spark.createDataFrame([("a", 1, 7, 2, "x", 1)] * 3 + [("a", 2, 1, 2, "y", 2)], "src string, score int, id long, lim int, _cut_hi string, _g0 int")
    out = capping.cap_records(same, ["src"], "score", "id", "lim")
    # equal keys stand or fall together: one better row stays, the three ties don't fit
    assert sorted((r.id, r.over_limit) for r in out.collect()) == [(1, False), (7, True), (7, True), (7, True)] and "_cut_hi" in out.columns


# --- 2 ---------------------------------------------------------------------------------------

TEXT = "The council voted to extend the water levy by two years, and the ministry published its terms. Farmers in the valley disputed the baseline before the session."
#: Furniture in words of its own, in English and Dutch: none of it stands in the package.
SITES = (
    ("The Weir", ("Front | Desk | People | Archive", "Stories » Water"), ("This website stores data such as preferences and visits.", "Get our weekly digest by post", "May be reproduced with attribution to The Weir."), ("What readers opened today", "Picked for you")),
    ("De Sluis", ("Voorpagina | Redactie | Archief", "Verhalen » Water"), ("Deze site bewaart gegevens over uw bezoek.", "Ontvang elke maandag onze brief", "Overname toegestaan met vermelding van De Sluis."), ("Veel geopend vandaag", "Voor u gekozen")),
    ("Northern Gauge", ("Start | Themes | Staff", "Reports » Rivers"), ("Visits to this website are measured.", "Ask for our letter on Fridays", "Text may be reused if Northern Gauge is named."), ("Also on the gauge", "Others opened")),
)


def site_pages(n, seed=12):
    """(page, numbers of the lines that aren't the article's) of made-up sites; one page in ten has no article."""
    rng = random.Random(seed)
    pick = lambda *w: rng.choice(w)
    phrase = lambda: f"{pick('the council', 'a ministry', 'two banks', 'seven towns', 'the port union', 'a tribunal', 'de raad', 'het bestuur')} {pick('extends', 'puts off', 'weighs', 'disputes', 'recalculates', 'verlengt', 'betwist')} {pick('a levy', 'the tariff', 'the treaty', 'a loan', 'de heffing', 'het verdrag')} {pick('for herders', 'in the valley', 'by a year', 'after talks', 'in de vallei', 'voor vissers')}"
    out = []
    for _ in range(n):
        _, top, notes, heads = pick(*SITES)
        lines = [(t, True) for t in top]
        if rng.random() < 0.9:
            for k in range(rng.randrange(2, 5)):
                if k and rng.random() < 0.3:
                    lines.append((f"On {phrase()}", False))
                lines.append((". ".join(phrase().capitalize() for _ in range(rng.randrange(2, 5))) + f", in {rng.randrange(1900, 2030)} and {rng.randrange(10**6)}.", False))
        lines += [(pick(*heads), True), *((phrase().capitalize(), True) for _ in range(rng.randrange(1, 4)))]
        lines += [(t, True) for t in rng.sample(notes, rng.randrange(1, 4))]
        out.append(("\n".join(t for t, _ in lines), {k for k, (_, bad) in enumerate(lines, 1) if bad}))
    return out


def test_boilerplate_held_out():
    pages = site_pages(600)
    model = boilerplate.fit([p for p, _ in pages[:400]], boilerplate.shares_of([p for p, _ in pages]))
    got = [set(x) for x in boilerplate.furniture_lines([p for p, _ in pages[400:]], model)]
    true = [t for _, t in pages[400:]]
    both = sum(len(a & b) for a, b in zip(got, true, strict=True))
    assert both > 0.95 * sum(map(len, true)) and both > 0.98 * sum(map(len, got))


def test_boilerplate_learner_decides():
    import numpy as np

    pages = [p for p, _ in site_pages(600)]
    model = boilerplate.fit(pages[:400], boilerplate.shares_of(pages))
    with_trees = boilerplate.furniture_lines(pages[400:], model)
    model.trees = boilerplate.fit_trees(np.zeros((0, boilerplate.FEATURES), np.float32), np.zeros(0))
    assert with_trees != boilerplate.furniture_lines(pages[400:], model)


def test_boilerplate_words_carry_over():
    pages = site_pages(600)
    model = boilerplate.fit([p for p, _ in pages], boilerplate.shares_of([p for p, _ in pages]))
    # lines that no page has, in the words of those that many have
    page = "Front | People | Archive | Themes\n\n" + "\n".join(TEXT for _ in range(3)) + "\n\nOthers picked\nSeven towns weigh the loan\nOntvang onze brief elke vrijdag\nMay be reused with attribution."
    assert set(boilerplate.furniture_lines([page], model)[0]) == {1, 7, 8, 9, 10}


def test_boilerplate_repeated_lines(spark):
    pages = [p for p, _ in site_pages(300)]
    pages += [pages[0]] * 7 + ["", "\n", "  \u200b Front | Desk | People | Archive\t"]
    got = boilerplate.repeated_lines(spark.createDataFrame([(p,) for p in pages] + [(None,)], "page string"), "page")
    want = boilerplate.shares_of(pages)
    # marks that share a bit may hide a line that is on few pages
    assert want and {k for k, v in want.items() if v > 0.05} <= set(got) <= set(want) and all(abs(want[k] - v) < 1e-9 for k, v in got.items())
    # a line that only copies of one page have isn't repeated
    assert not {x.key for x in boilerplate.read_lines(pages[0]) if ", in " in x.text} & set(got)


def test_boilerplate_counts_every_page(spark, monkeypatch):
    pages = [p for p, _ in site_pages(300)] + ["", "\n"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)] + [(999, None)], "id long, page string")
    shares = boilerplate.repeated_lines(df, "page")
    want = boilerplate.count_pages([boilerplate.read_lines(p, shares) for p in pages])
    model = boilerplate.model_for(df, "id", "page", 20)
    assert want.lines and model.lines == want.lines
    assert model.words.keys() == want.words.keys() and all(abs(model.words[w] - v) < 1e-9 for w, v in want.words.items())
    # counts that a task passes on in parts
    monkeypatch.setattr(boilerplate, "HELD", 30)
    assert boilerplate.count_all(df, "page", shares) == want


def test_boilerplate_odd_cases(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "\n".join(["word " * 200 + "end."] * 300), "z"), (3, "Home", "z")], "id long, page string, lines string")
    assert {(r.id, len(r.lines)) for r in boilerplate.page_lines(df, "id", "page").collect()} == {(2, 0), (3, 0), (3, 1)}
    assert boilerplate.page_lines(df.limit(0), "id", "page").count() == 0
    assert {r.id: r.article is None for r in boilerplate.main_text(df.limit(2), "id", "page").collect()} == {1: True, 2: False}


def test_decoding_takes_sections_whole():
    import numpy as np

    lines = boilerplate.read_lines("Most read\nA title\nAnother title\n\n" + TEXT)
    assert boilerplate.decode(lines, np.array([3.0, -0.5, 2.0, -4.0])).tolist() == [True, True, True, False]
    assert boilerplate.decode(boilerplate.read_lines("A title\nAnother"), np.array([-1.0, -1.0])).all()


# --- 3 ---------------------------------------------------------------------------------------

GOOD = (
    "The home office in Tamsoro will search its archive for contacts with smallholders.", "Talvera trains 680 young coders in JavaScript to run its water tariff.", "To be completed by 2029, the seed bank brings forward a cold-chain programme.",
    "Negotiators left a placeholder article on the tax treaty [Article 4] without a vote.", "Tamsoro's XXX Congress of river mayors endorsed a tender.", "About 404 households were not found by the census.", "Spending rose from $3m to $66m, 100% of it for traders [see table 6].",
    "The clause (options {A} and {B}) pays for the quota.", "Null results dominate: the plan had an undefined effect on lenders.", "All rights reserved to upstream users remain in dispute.",
)
BAD = (
    "{{ title }} quietly revised a levy.", "The ${summary} explains why.", "TBD", "todo - write one sentence", "404 Not Found", "Please enable JavaScript to view this page.", "The council voted. Loading, please wait…", "Lorem ipsum dolor sit amet.", "[Country] rejected [policy] within months.",
    "Fennmark raised its levy by XX per cent in 20XX.", "&lt;event_name&gt; halved its contribution.", "<%= item.summary %>", "It did so according to [Insert TITLE here].", "Seite nicht gefunden - Commonwell Trust", "NaN", "%s port union signed off.", "503 Service Temporarily Unavailable",
)


#: None of these stands in the trusted records; Dutch, Portuguese and Polish aren't languages of the data.
UNSEEN = (
    "La página solicitada no existe.", "This content is blocked in your country.", "Something went wrong, try again later", "Die angeforderte Seite wurde nicht gefunden.", "[COMPANY] announced new tariffs", "Error code 1020",
    "Pagina niet gevonden", "Você precisa ativar o JavaScript no navegador", "Hello {first_visit}, your report is ready", "The council voted. You need cookies and scripts to continue reading this page.",
)


def ordinary(n, seed=5):
    """Sentences of many words, about one in twenty of them with residue in them."""
    rng = random.Random(seed)
    pick = lambda *w: rng.choice(w)
    out = []
    for _ in range(n):
        s = f"{pick('The council', 'A ministry', 'Two banks', 'Fishing crews', 'The home office', 'Seven towns', 'A tribunal')} {pick('voted to extend', 'put off', 'weighed', 'will search', 'published the terms of', 'disputed')} {pick('a levy', 'the tariff', 'its archive', 'the treaty', 'a loan', 'the census')} {pick('for herders', 'in the valley', 'by a year', 'after talks', 'on the coast', 'of the port union')}."
        out.append(pick(*BAD) if rng.random() < 0.05 else s + " " + pick(*GOOD) if rng.random() < 0.2 else s)
    return out


def residue_model():
    return residue.fit(ordinary(2000))


def test_residue_by_the_model():
    scorer = residue_model().scorer()
    assert [v for v in BAD if not scorer.is_residue(v)] == [] and [v for v in GOOD if scorer.is_residue(v)] == []


def test_residue_in_unseen_words():
    scorer = residue_model().scorer()
    assert not set(UNSEEN) & set(residue.trusted())
    assert [v for v in UNSEEN if not scorer.is_residue(v)] == []


def test_residue_learner_decides():
    import numpy as np

    idle = residue.Model(np.zeros(residue.WIDTH), 0.0, residue_model().threshold).scorer()
    assert not any(map(idle.is_residue, BAD))
    # what the unlabelled values say of "service unavailable" changes the verdict on it
    plain = residue.fit([])
    told = residue.fit([f"The service was unavailable to {n} farmers in the valley, and the council will look again." for n in range(100, 400)])
    text = "The service was unavailable to 512 farmers"
    assert plain.scorer().score(text) > told.scorer().score(text)


def test_residue_scores_are_those_of_the_worst_passage():
    model = residue_model()
    for v in (*GOOD, *BAD, "", "One. Two three! " * 40, "word " * 100):
        direct = max((sum(model.odds[f] for f in residue._hashed(p)) for p in residue.passages(v)), default=-30.0)
        assert abs(model.scorer().score(v) - max(direct, -30.0) - model.prior) < 1e-6


def test_residue_odd_cases(spark):
    rows = [(1, None), (2, "  "), (3, "TBD"), (3, "TBD"), (4, "The council voted to extend the levy. " * 3000), (5, "The council voted. " * 3000 + "{{ title }}")]
    df = spark.createDataFrame(rows, "id long, v string")
    got = residue.residue_values(df, "id", "v")
    assert sorted((r.id, r.is_residue) for r in got.collect()) == [(3, True), (3, True), (4, False), (5, True)]
    assert residue.residue_values(df.limit(0), "id", "v").count() == 0


def test_boilerplate_reads_long_lines():
    notice = "We use cookies to improve this site. "
    cues = boilerplate.read_line(notice)[2]
    assert cues and boilerplate.read_line(notice * 20)[2] & cues
    assert boilerplate.read_line(" | ".join(["Home", "About", "Contact"] * 20))[3] == 60
    # a notice of 740 characters that pages repeat is no running text
    pages = [p + "\n" + notice * 20 for p, _ in site_pages(300)]
    model = boilerplate.fit(pages, boilerplate.shares_of(pages))
    assert all(p.count("\n") + 1 in x for p, x in zip(pages, boilerplate.furniture_lines(pages, model), strict=True))


def test_boilerplate_steps_of_long_lines():
    import sys

    def steps(words):
        rng = random.Random(words)
        pages = ["\n".join(" ".join(rng.choice(["Dams", "weigh", "tolls", "naïve", "—", "1,200"]) for _ in range(words)) + "." for _ in range(10)) for _ in range(20)]
        n = 0

        def count(frame, event, what):
            nonlocal n
            n += event in ("call", "c_call")

        sys.setprofile(count)
        try:
            boilerplate.furniture_lines(pages, model)
        finally:
            sys.setprofile(None)
        return n

    pages = [p for p, _ in site_pages(100)]
    model = boilerplate.fit(pages, boilerplate.shares_of(pages))
    steps(100)
    # a call for every word would take eight times as many
    assert steps(1000) < 1.5 * steps(100)


def test_boilerplate_reads_odd_lines():
    import re

    odd = ["Kelvin \u212a Straße ﬁn ƒ² x²y", "İstanbul’s “naïve” œuvre — 1,200 m² ª º µ", "Read more, read_next", "see\u00a0also the droits réservés", "mots-clés: read mots clés", "Русский текст 5", "a\u0301b c", "x\x81y\x85z", "隐私 policy 公司", "一、二 abc", "→ next » © 2024", "한국어 login", "𝐀bc ① ٣"]
    for t in odd:
        low = t.lower()
        far = bool(re.search("[぀-ヿ㐀-鿿가-힯]", t))
        want = [a + b for a, b in zip(low, low[1:], strict=False) if a.isalpha() and b.isalpha()] if far else re.findall(r"[^\W\d_]+", low)
        cues = 0
        for k, tokens_of in enumerate(boilerplate.ATTRIBUTES.values()):
            for w in tokens_of.replace("-", " ").split("|"):
                seen = f" {' '.join(want)} ".find(f" {w} ") >= 0 if w[0].isalpha() else w in low
                cues |= seen << k
        got = boilerplate.read_line(t)
        assert (got[1], got[9], got[2]) == (want, far, cues), t


def test_boilerplate_features_by_page():
    import numpy as np

    pages = [p for p, _ in site_pages(60)]
    model = boilerplate.fit(pages, boilerplate.shares_of(pages))
    pages = ["", "Home", *pages, "\n \n", "Most read\nA title\n\n" + TEXT, TEXT]
    read = [boilerplate.read_lines(p, model.shares) for p in pages]
    parts = [boilerplate.sections(x) for x in read]
    alone = [boilerplate.node_features([x], [s], model) for x, s in zip(read, parts, strict=True)]
    together = boilerplate.node_features(read, parts, model)
    assert np.allclose(together, np.concatenate(alone), rtol=1e-6, atol=0) and len(together) == sum(map(len, read))
    for x, sects, f in zip(read, parts, alone, strict=True):
        for first, end, _ in sects:
            size = np.array([len(y.text) for y in x[first:end]], float)
            assert np.allclose(f[first:end, [2, 5]], [size.mean(), size.std()], rtol=1e-5)
        for i, (y, v) in enumerate(zip(x, f.tolist(), strict=True)):
            odds = [model.words.get(w, 0.0) for w in y.words] or [0.0]
            assert np.allclose(v[24:27], [sum(odds) / len(odds), max(odds), min(odds)], atol=1e-6)
            past, coming = [j for j in range(i) if x[j].sentence], [j for j in range(i + 1, len(x)) if x[j].sentence]
            assert v[31:33] == [len(past), len(coming)] and v[33:35] == [min(20, i - past[-1] if past else 20), min(20, coming[0] - i if coming else 20)]
            assert v[35] == (0 if i == 0 else np.log1p(np.float32(len(x[i - 1].text)))) and v[40] == (i + 1 < len(x) and x[i + 1].share > 0)
    assert boilerplate.furniture_lines(pages, model) == [boilerplate.furniture_lines([p], model)[0] for p in pages]


# --- 4 ---------------------------------------------------------------------------------------


def canon(s):
    head, _, query = s.partition("?")
    f = lambda x: "".join(y for c in x for y in c.lower()[:3] if c.isalnum() and y.isalnum())
    return f(head), tuple(sorted(z for z in map(f, query.split("&")) if z))


def test_spelling_as_canonical_strings(spark):
    rng = random.Random(4)
    base = ["https://a.example/x?id=1&k=2", "http://b.example/é/ß", "x", "", "?", "?a=1", "a=1", "İstanbul", "流域/政策", "https://a.example/x?id=12&k="]
    out = []
    for _ in range(600):
        s = rng.choice(base)
        s = "".join((c.upper() if rng.random() < 0.2 and len(c.upper()) == 1 else c) + rng.choice(["", "", "", " ", "​", "-", "\xa0"]) for c in s)
        if "?" in s and rng.random() < 0.5:
            h, _, q = s.partition("?")
            fields = q.split("&")
            rng.shuffle(fields)
            s = h + "?" + "&".join(fields)
        out.append(s)
    df = spark.createDataFrame(list(enumerate(out)) + [(9999, None)], "id long, url string")
    first, expected = {}, set()
    for i, s in enumerate(out):
        k = canon(s)
        if k in first:
            expected.add((first[k], i))
        first.setdefault(k, i)
    got = {(r.first_id, r.copy_id) for r in spelling.hidden_copies(df, "id", "url").collect()}
    assert got == expected
    counts = Counter(map(canon, out))
    assert sorted(r.n_copies for r in spelling.collapse(df, "id", "url").collect()) == sorted(counts.values())


def test_spelling_collisions_are_told_apart(spark, monkeypatch):
    df = spark.createDataFrame([(1, "ab", 0), (2, "cd", 0), (3, "A-B", 0), (4, "c d", 0)], "id long, text string, h long")
    rows = spelling.with_spelling_hash(df.select("id", "text"), "text").withColumnsRenamed({"h1": "x", "h2": "y"}).selectExpr("id", "text", "0L as h1", "0L as h2", "h3")
    monkeypatch.setattr(spelling, "with_spelling_hash", lambda *_: rows)
    got = {(r.first_id, r.copy_id) for r in spelling.hidden_copies(df.select("id", "text"), "id", "text").collect()}
    assert got == {(1, 3), (2, 4)}


def test_spelling_that_all_hashes_confuse(spark):
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    x, y, z = a + a, a + b, b + a
    assert (spelling.hashes([x, y], True) == spelling.hashes([z, z], True)).all()
    df = spark.createDataFrame([(1, x), (2, y), (3, z), (4, x.upper()), (5, f"{y}-"), (6, f"{z}!"), (7, f"-{z}"), (8, "x")], "id long, url string")
    assert {(r.first_id, r.copy_id) for r in spelling.hidden_copies(df, "id", "url").collect()} == {(1, 4), (2, 5), (3, 6), (3, 7)}


def test_spelling_odd_cases(spark):
    df = spark.createDataFrame([(1, "x" * 100_000, "h"), (2, "X " * 100_000, "h"), (3, "!!", "h"), (4, "??", "h")], "id long, url string, h1 string")
    assert {(r.first_id, r.copy_id) for r in spelling.hidden_copies(df, "id", "url").collect()} == {(1, 2), (3, 4)}
    assert spelling.hidden_copies(df.limit(0), "id", "url").count() == 0


# --- 6 ---------------------------------------------------------------------------------------


def test_history_as_brute_force(spark):
    c = table(spark, DATA, "candidates").selectExpr("candidate_id id", "url", "doi", "content_fingerprint fingerprint", "title", "summary_hint summary")
    h = table(spark, DATA, "history").selectExpr("history_id id", "url", "doi", "fingerprint", "title", "summary_hint summary")
    mine = [(r.id, history.words(r.title) + history.words(r.summary)) for r in c.collect() if len(history.words(r.summary)) >= history.SHORT]
    theirs = [(r.id, history.words(r.title) + history.words(r.summary)) for r in h.collect() if len(history.words(r.summary)) >= history.SHORT]
    expected = {(k, i) for i, a in mine for k, b in theirs if history.same_text(b, a)}
    got = {(r.kept_id, r.id) for r in history.content_pairs(c, history.Accepted(h)).collect()}
    assert expected and got <= expected and len(got) >= 0.9 * len(expected)


def test_history_keys(spark):
    urls = ["https://www.a.example/x?b=1&utm_source=z&a=2#top", "HTTP://a.example/X?a=2&&b=1", "a.example/x?a=2&b=1&fbclid=9", "https://a.example/x?a=2", None, " "]
    keys = [r.k for r in spark.createDataFrame([(u,) for u in urls], "u string").select(history.url_key("u").alias("k")).collect()]
    assert keys[0] == keys[1] == keys[2] and keys[3] not in (None, keys[0]) and keys[4:] == [None, None]
    dois = ["https://doi.org/10.99918/RRJ.2024.5", " doi: 10.99918/rrj.2024.5. ", "10.0000/unknown", "-", "pending", "n/a", "10.1234/none", None]
    keys = [r.k for r in spark.createDataFrame([(u,) for u in dois], "u string").select(history.doi_key("u").alias("k")).collect()]
    assert keys[0] == keys[1] and keys[0] and set(keys[2:]) == {None}
    fps = ["SHA256:50EB290FD271BB0988009092", "50eb290fd271bb0988009092 ", "e3b0c44298fc1c149afbf4c8", "E3B0C44298FC1C149AFBF4C8", "", "none", None]
    keys = [r.k for r in spark.createDataFrame([(u,) for u in fps], "u string").select(history.fingerprint_key("u").alias("k")).collect()]
    assert keys[0] == keys[1] and keys[0] and set(keys[2:]) == {None}


def test_history_appends_and_odd_cases(spark, tmp_path):
    kind = "id long, url string, doi string, fingerprint string, title string, summary string"
    body = "By June 2024 the council of the northern basin voted to extend the water levy while donors waited for figures and farmers disputed the baseline of the accord"
    old = spark.createDataFrame([(1, None, None, None, "Levy", body), (2, None, None, None, "Same title", None)], kind)
    new = spark.createDataFrame([(10, None, None, None, "Levy", body.replace("water", "river").upper()), (11, None, None, None, "Levy", body.replace("water", "river").upper()), (12, None, None, None, "Same title", None), (13, None, None, None, None, "word " * 20_000)], kind)
    path = str(tmp_path / "store")
    history.Store.create(path, old.where("id = 2"), 32).append(old.where("id = 1"))
    got = history.duplicates(new, history.Store.open(spark, path, 32))
    assert {(r.kept_id, r.id) for r in got.collect()} == {(1, 10), (1, 11)}
    assert history.duplicates(new.limit(0), old).count() == 0 and history.duplicates(new, old.limit(0)).count() == 0


def test_history_short_summaries(spark):
    kind = "id long, url string, doi string, fingerprint string, title string, summary string"
    old = spark.createDataFrame([(1, None, None, None, "Levy", "Votes put off again."), (2, None, None, None, "Levy", "..."), (3, None, None, None, "Port", "Votes put off")], kind)
    new = spark.createDataFrame([(10, None, None, None, "LEVY", "votes <b>put</b> off, again"), (11, None, None, None, "Levy", "Votes put off"), (12, None, None, None, "Levy", "...")], kind)
    assert {(r.kept_id, r.id) for r in history.duplicates(new, old).collect()} == {(1, 10)}


def test_history_reads_what_a_batch_needs(spark, tmp_path):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    kind = "id long, url string, doi string, fingerprint string, title string, summary string"
    rows = [(i, f"https://h.example/{i}", None, None, word(), " ".join(word() for _ in range(30))) for i in range(300)]
    old = spark.createDataFrame(rows, kind)
    path = str(tmp_path / "store")
    history.Store.create(path, old, 128)
    read = {}
    for n in (1, 60):
        store = history.Store.open(spark, path, 128)
        batch = spark.createDataFrame([(1000 + r[0], r[1] if k % 2 else None, None, None, r[4], r[5]) for k, r in enumerate(rows[:n])], kind)
        assert {(r.kept_id, r.id) for r in history.duplicates(batch, store).collect()} == {(i, 1000 + i) for i in range(n)}
        read[n] = sum(store.read.values())
    assert read[1] < 12 and read[1] < read[60] / 4


def test_history_phrases_in_common_are_not_written(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    phrases = [" ".join(word() for _ in range(7)) for _ in range(60)]
    kind = "id long, url string, doi string, fingerprint string, title string, summary string"
    rows = [(i, None, None, None, None, " ".join(rng.choice(phrases) for _ in range(10))) for i in range(400)]
    old = spark.createDataFrame(rows, kind)
    new = spark.createDataFrame([(1000 + i, None, None, None, None, s.replace("a", "x", 4)) for i, *_, s in rows[:200]] + [(3000 + i, None, None, None, None, " ".join(rng.choice(phrases) for _ in range(10))) for i in range(200)], kind)
    accepted = history.Accepted(old)
    theirs, mine = ([(r.id, history.words(r.summary)) for r in df.collect()] for df in (old, new))
    expected = {(k, i) for k, a in theirs for i, b in mine if history.same_text(a, b)}
    pairs = history.duplicates(new, accepted)
    assert {(r.kept_id, r.id) for r in pairs.collect()} == expected and len(expected) >= 200
    # nearly all of the 160,000 pairs share a phrase; those that are written are about those that are the same
    chunked = history._chunked(new, accepted.common)
    probes = chunked.select(F.explode("chunks").alias("hash"), "id", *history.BITS, "words")
    assert history.meet(accepted.near("postings", probes), probes).distinct().count() < 2 * len(expected)
    # no more bits differ than words do
    for (_, a), (_, b) in zip(theirs, mine, strict=True):
        bits = sum(bin((x ^ y) & ((1 << 64) - 1)).count("1") for x, y in zip(history.parity(a), history.parity(b), strict=True))
        assert bits <= len(a) + len(b) - 2 * (Counter(a) & Counter(b)).total()


# --- 7 ---------------------------------------------------------------------------------------


def test_truncation_held_out(spark):
    values = [r[0] for r in table(spark, DATA, "candidates").where("trim(summary_hint) <> ''").orderBy("candidate_id").select("summary_hint").collect()]
    whole = [v for v in values if v.rstrip()[-1:] in ".?。"]
    (model,), rng = truncation.fit([values[::2]]), random.Random(1)
    cut = [c for v in whole[1::2] if (c := truncation.cut_artificially(v, rng, [100, 140]))]
    assert sum(s > 0.5 for s in model.score(cut)) > 0.95 * len(cut)
    assert sum(s < 0.5 for s in model.score(whole[1::2])) > 0.95 * len(whole[1::2])


def test_truncation_statistics_cover_every_row(spark):
    rng = random.Random(2)
    values = ["x" * rng.randrange(20, 4000) for _ in range(3000)] + ["y" * 777 for _ in range(40)] + [f"It rained. Filed by desk {i}" for i in range(12)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(-1, None), (-2, " ")], "id long, _value string")
    piled, phrases = truncation.corpus_statistics(rows)
    assert 777 in piled and truncation._phrase_hash("filed by desk #") in phrases
    # a sample of 50 rows holds neither eight values of a length nor six of a phrase
    (model,) = truncation.models_for([(rows, "id", "_value")], sample=50)
    assert 777 in model.piled and phrases <= model.frequent


#: Closing remarks that no text of the package holds, one Dutch.
REMARKS = ("Stay tuned for part two", "Inschrijven voor 3 mei 2026", "(Filed from the northern desk)", "Signed: the regional editor", "Talks resume on 14 May 2026", "Files at https://x.example/1")


def reports(n, seed=3):
    """Texts of some sentences; one in five closes with a remark, one in eight is cut."""
    rng = random.Random(seed)
    pick = lambda *w: rng.choice(w)
    out = []
    for k in range(n):
        one = lambda: f"{pick('The council', 'A ministry', 'Two banks', 'Fishing crews', 'Seven towns', 'By May 2024, farmers')} {pick('voted to extend', 'put off', 'weighed', 'disputed', 'recalculated')} {pick('a levy', 'the tariff', 'the treaty', 'a loan')} {pick('for herders', 'in the valley', 'by a year', 'after talks', 'of the port union')}."
        text = " ".join(one() for _ in range(rng.randrange(2, 6)))
        if k % 8 == 0:
            text = text[: rng.randrange(30, len(text) - 6)].rstrip(" .")
        elif k % 5 == 0:
            text += " " + pick(*REMARKS)
        out.append(text)
    return out


def test_truncation_cases():
    (model,) = truncation.fit([reports(3000)])
    body = "The council voted to extend the levy in the northern basin. "
    whole = [*REMARKS, "Inschrijven voor 21 juni 2026", "(Filed from the northern desk) […]", "Farmers disputed it.", "It ended. […]", "It ended. (4 min read)", "It ended. Share this.", "It ended.</p>", "It ended.”", "It ended. […] ”", "It ended. [...]”</p>"]
    cut = ["Farmers in the", "Farmers in th…", "Farmers disputed [...]", "Farmers disputed the base… Continue reading →", "Farmers</", 'Farmers <a href="htt', "Farmers&#82", "Farm�", "Farmers disputed the... Read more Share this.", "Farmers dispu”", "Farmers disputed […] ”", "Inschrijven vo"]
    assert [w for w in whole if model.score([body + w])[0] > 0.5] == []
    assert [w for w in cut if model.score([body + w])[0] < 0.5] == []
    assert model.score([None, "", "  "]) == [None, None, None]


def test_truncation_learner_decides():
    # where no value of the corpus closes with a remark, the same remarks are cut texts
    (plain,) = truncation.fit([[t for t in reports(3000) if not t.endswith(REMARKS)]])
    body = "The council voted to extend the levy in the northern basin. "
    assert sum(plain.score([body + r])[0] > 0.5 for r in REMARKS) >= 3


def test_truncation_odd_cases(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (3, "It ended. " * 20_000, 2.0), (3, "It ended. " * 3, 2.0)], "id long, v string, score double")
    assert sorted((r.id, r.is_cut) for r in truncation.cut_values(df.drop("score"), "id", "v").collect()) == [(3, False), (3, False)]
    assert truncation.cut_values(df.drop("score").limit(0), "id", "v").count() == 0


# --- 8 ---------------------------------------------------------------------------------------

ODD = ["", "a", " ", "\n\n  x", "don't 12 12:30 ...", "<|endoftext|> x", "流域政策" * 3000, "word " * 9000, "x" * 30_000, "a  b\t c　d " * 4000, "🙂 é ﬁ ​­" * 2000, "   " * 5000, "1234567890" * 3000 + " end"]


def test_tokens_round_trip_and_pieces():
    path = tokens.vocabulary_path()
    enc = tokens.encoding(path)
    for t in ODD:
        ids = tokens.encode(t, path)
        assert ids == (enc.encode_ordinary(t) if t else []) and tokens.decode(ids, path) == t.encode()
        assert "".join(tokens.safe_pieces(t, 50)) == t
        assert [i for p in tokens.safe_pieces(t, 50) for i in enc.encode_ordinary(p)] == ids


def test_tokens_as_the_other_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(tokens.vocabulary_path().replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    docs = [r.text for r in table(spark, DATA, "documents").collect() if r.text]
    for d, e in zip(docs, t.encode_batch(docs, add_special_tokens=False), strict=True):
        assert tokens.encode(d, tokens.vocabulary_path()) == e.ids


def test_tokens_table(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "two words", "b")], "doc_id long, text string, _text string")
    got = tokens.with_token_ids(df)
    assert got.columns == ["doc_id", "text", "_text", "ids"] and sorted(len(r.ids) for r in got.collect()) == [0, 0, 2]
    assert tokens.with_token_ids(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        tokens.with_token_ids(df, out="doc_id")


# --- 9 ---------------------------------------------------------------------------------------


def test_raking():
    tokens_ = {("a", "x"): 60.0, ("a", "y"): 40.0, ("b", "x"): 10.0, ("b", "y"): 90.0}
    w = mixing.rake(tokens_, {c: n * 2 for c, n in tokens_.items()}, [{"a": 50.0, "b": 50.0}, {"x": 40.0, "y": 60.0}])
    assert abs(w["a", "x"] + w["a", "y"] - 50) < 1e-6 and abs(w["a", "x"] + w["b", "x"] - 40) < 0.5
    capped = mixing.rake({("a", "x"): 10.0, ("a", "y"): 90.0}, {("a", "x"): 5.0, ("a", "y"): 90.0}, [{"a": 80.0}, {}])
    assert capped["a", "x"] <= 5.0 and abs(sum(capped.values()) - 80) < 1e-6


def test_mix_reaches_its_shares(spark):
    rng = random.Random(6)
    docs = [(i, "abc"[i % 3], rng.choice(["en", "fr", None]), "t", rng.randrange(1, 60)) for i in range(3000)]
    docs += [(9001, None, "en", "t", 5), (9002, "a", "en", "t", 0), (9003, "z", "en", "t", 9)]
    d = spark.createDataFrame(docs, "doc_id long, source string, lang string, topic string, n_tokens long")
    t = spark.createDataFrame([("a", 0.7, 3), ("b", 0.2, 1), ("c", 0.1, 1), ("none", 0.0, 2), ("gone", 0.0, None)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(d, t)
    rows = mixed.collect()
    assert len({r.doc_id for r in rows}) == len(rows) and all(r.repeats <= {"a": 3, "b": 1, "c": 1}[r.source] for r in rows) and not {9001, 9002, 9003} & {r.doc_id for r in rows}
    for r in mixing.reached(mixed, t).collect():
        assert abs(r.reached_share - r.target_share) < 0.002
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(d, t).collect()))
    full = {(r.kind, r.value): r for r in mixing.reached_marginals(mixed, d, t).collect()}
    assert {k for k, _ in full} == {"source", "lang", "topic"} and ("lang", None) in full and full["topic", "t"].reached_share == 1.0
    assert all(abs(r.reached_share - r.target_share) < 0.03 for (k, _), r in full.items() if k == "lang")
    assert all(r.missing_tokens <= 60 for (k, _), r in full.items() if k == "source")
    assert mixing.mix(d.limit(0), t).count() == 0 and mixing.mix(d, t.limit(0)).count() == 0


def test_mixing_fills_whatever_gap_a_large_document_leaves(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FILL", 4)
    rng = random.Random(8)
    small = [(i, "a", "en", "x", rng.randrange(150, 250)) for i in range(400)]
    docs = [*small, *((1000 + i, "a", "en", "x", 30_000) for i in range(6)), *((2000 + i, "b", "en", "x", 200) for i in range(100))]
    d = spark.createDataFrame(docs, "doc_id long, source string, lang string, topic string, n_tokens long")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    for seed in range(4):
        used = {r.doc_id: r.n_tokens for r in mixing.mix(d, t, total_tokens=40_000.0, seed=seed).collect() if r.source == "a"}
        gap = 20_000 - sum(used.values())
        assert 0 <= gap < min(n for i, *_, n in small if i not in used)


# --- 10 --------------------------------------------------------------------------------------


def test_pieces_cover_and_overlap(spark):
    path = tokens.vocabulary_path()
    texts = [t for t in ODD if t] + [("A sentence of some words, with a clause. " * 30 + "\n\n") * 20]
    df = spark.createDataFrame([(i, t, "p") for i, t in enumerate(texts)] + [(100, None, "p"), (101, "", "p")], "doc_id long, text string, piece string")
    got = defaultdict(list)
    for r in splitting.split_items(df, limit=128, overlap=16).orderBy("doc_id", "piece_no").collect():
        got[r.doc_id].append(r)
    assert set(got) == set(range(len(texts)))
    for i, t in enumerate(texts):
        ids, parts = tokens.encode(t, path), got[i]
        assert parts[0].from_token == 0 and parts[-1].from_token + parts[-1].n_tokens == len(ids)
        for a, b in zip(parts, parts[1:]):
            assert 12 <= a.from_token + a.n_tokens - b.from_token <= 16 and b.from_token > a.from_token
        for p in parts:
            assert p.n_encoded == len(tokens.encode(p.piece, path))
            assert p.n_tokens <= 128 and p.piece.encode() == tokens.decode(ids[p.from_token : p.from_token + p.n_tokens], path)
    assert all(p.piece.rstrip()[-1] == "." for p in got[len(texts) - 1])
    assert max(parts[0].n_tokens for parts in got.values()) > 128 - 16
    big = {r.doc_id for r in splitting.oversized(df, limit=128).collect()}
    assert big == {i for i, t in enumerate(texts) if len(tokens.encode(t, path)) > 128}
    assert splitting.split_items(df.limit(0)).count() == 0


def test_boundaries():
    import numpy as np

    path = tokens.vocabulary_path()
    marks = lambda t: splitting.strengths(t, tokens.token_sizes(path)[tokens.encode(t, path)])
    assert marks("One two. Three, four\nfive\n\nsix")[2] == "S" and set(marks("x" * 200)) <= {"T", "L", "P", "W"}
    assert "x" in marks("流域政策观察") and marks("a") and isinstance(np.array([1]), np.ndarray)


