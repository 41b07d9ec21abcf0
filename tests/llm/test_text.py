import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from pageatlas.llm import boilerplate, pii, quality, terms

GIVEN = frozenset({"zoé", "bram", "odile"})


def kinds(line):
    return sorted({k for _, _, k in pii.find_in_line(line, GIVEN)})


# --- terms ----------------------------------------------------------------------------------------

FOCUSES = "focus_id string, summary string, tags array<string>, term string, tf string, records string, n string"


def test_weights_equal_brute_force(spark):
    rows = [("a", "Rivers and rivers again", ["Long_Term", " long-term ", "", None]), ("b", "rivers", None), ("c", None, []), ("d", "CAFÉ été Straße", ["café"]), ("a", "Rivers and rivers again", ["Long_Term", " long-term ", "", None])]
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], FOCUSES)
    tf = defaultdict(Counter)
    tf["a"].update({"rivers": 2, "again": 1, "long term": 2})
    tf["b"].update({"rivers": 1})
    tf["d"].update({"café": 2, "straße": 1})
    want = {}
    for f, c in tf.items():
        for t, k in c.items():
            all_k = [x[t] for x in tf.values() if t in x]
            h = -sum(x / sum(all_k) * math.log(x / sum(all_k)) for x in all_k)
            want[(f, t)] = (k, len(all_k), math.log1p(k) * (1 - h / math.log(4)))
    got = {(r["focus_id"], r["term"]): r for r in terms.term_weights(df).collect()}
    assert set(got) == set(want)
    for key, (k, n, w) in want.items():
        assert (got[key]["tf"], got[key]["records"]) == (k, n) and abs(got[key]["weight"] - w) < 1e-9
    assert {(r["focus_id"], r["term"]) for r in terms.term_weights(df, 2, 5).collect()} == {("a", "rivers"), ("b", "rivers")}
    assert terms.term_weights(df.limit(0)).count() == 0


# --- personal information ---------------------------------------------------------------------------


def test_finds_each_kind():
    assert kinds("Write to a.b at post-field dot example") == ["email"]
    assert kinds("mail renske{at}buzon-field{dot}org or x(at)post-amber.test") == ["email"]
    assert kinds("ａb＠post.example and p&#64;q.example") == ["email"]
    for phone in ("+34 699 000 083", "0049 30 23125172", "030/23125-398", "(303) 555-0130", "01.99.00.96.97", "+44 (0)7700 900555", "07700 900100", "+14155550134", "699 00 074 41"):
        assert kinds(f"ring {phone} twice") == ["phone"], phone
    assert kinds("call five five five oh one two three four") == ["phone"]
    for number in ("my social security number is 904-01-2543", "tax id 983046729", "passeport nº 62XX97960", "NI number: QQ543212D", "Sozialversicherungsnummer 00 722018 X 654", "mi DNI es 00874840X", "meine Steuer-ID ist 00 208 483 403"):
        assert kinds(number) == ["id_number"], number
    for address in ("at 14B Søl Rd every", "Calle Pellow 27.", "Flat 23, 40 Gostescu Avenue, 81654 X", ": 13, chemin des Redds.", "Ruskallee 49, Hinterhaus.", "C/ Ulm Viejo, 52, 6.º B", "An der Lorvmühle 106, 10590 Rio"):
        assert kinds(address) == ["address"], address
    for name in ("My neighbor Bram Quintberg calls", "Zoé H. Tremescu", "with B. Naskutquist.", "Frau Marriwick hat", "I am ODILE BRANIHAM, living", "© 2010 Zoé Naskrud", "la señora Iversier"):
        assert kinds(name) == ["name"], name


def test_every_disguise_is_undone_on_lines_of_plain_letters():
    for left in ("[", "(", "{", "<", "|", "*", "_"):
        right = {"[": "]", "(": ")", "{": "}", "<": ">"}.get(left, left)
        for at in ("at", "AT", "ät", "arroba", "arobase", "chez", "bei", "à", "@"):
            for pad in ("", " ", "\t"):
                assert kinds(f"jane {left}{pad}{at}{pad}{right} host.org") == ["email"], (left, at, pad)
        for dot in ("dot", "punto", "point", "punkt", "pt", "."):
            if left != "_":
                assert kinds(f"jane@host {left} {dot} {right} org") == ["email"], (left, dot)
    for line in ("jane&#64;host.org", "jane&#X40;host.org", "jane&commat;host.org", "jane@host&#46;org", "jane@host&period;org", "jane@host dot org", "jane @ host.org", "jane @host.org",
                 "jane.d at host.org", "jane.d\tat\thost.org", "jane at host dot org", "jane arroba host punto org", "jane arobase host point org", "jane chez host pt org", "jane bei host punkt org", "ja\u200bne@host.org"):
        assert kinds(line) == ["email"], line
    for line in ("call five-five-five-oh-one-two-three", "call five,five,five,oh,one,two,three", "(call five five, five oh one - two three)", "call fıve five five ſix one two three"):
        assert kinds(line) == ["phone"], line


def test_guard_follows_from_every_transducer():
    import itertools

    parts = ["jane", " at ", "\tbei ", "(at)", "_at_", "| à|", "host", ".", "-x", " dot ", "{ pt }", "&#046;", "&Commat;", "six-ſix, ", "un,deux trois ", "nıne nine\t", " arroba ", "é"]
    for n in (3, 4):
        for line in map("".join, itertools.product(parts, repeat=n)):
            r = pii._undo(pii.Rewritten(line))
            assert r.text == line or pii._may_need(line, pii._low(line)), line


def test_what_is_no_case():
    for line in ("order 2025-118-0012 is late", "book 978-0-00-000024-2", "Build 4.17.0932", "4,250,000 coins", "Updated 08.09.2025 or 2025-09-08", "as @kelpfish", "garden@18.2", "River Lane is a song", "Room 14 on Tuesdays",
                 "© 2012 Yarrow Letters", "number QQ 18 77 85 C. What I did" if False else "Chapter 7 took 27 evenings", "85,237 visitors", "in 1:02:33", "Am 3. Mai 2024", "https://user@host.example/x", ""):
        assert kinds(line) == [], line


def test_offsets_and_redaction():
    text = "Ánna\r\nwrite Odilé no\nx [at] post-a [dot] org, +34 699 000 083!\n" + "long " * 20_000
    for n, s, e, k in pii.find_spans(text, GIVEN):
        assert text[:s].count("\n") == n
    assert [text[s:e] for _, s, e, _ in pii.find_spans(text, GIVEN)] == ["x [at] post-a [dot] org", "+34 699 000 083"]
    out = pii.redact_text(text, GIVEN)
    assert out == text.replace("x [at] post-a [dot] org", "[EMAIL]").replace("+34 699 000 083", "[PHONE]")
    assert pii.redact_text(None, GIVEN) is None and pii.redact_text("", GIVEN) == ""
    assert pii.redact_text("plain\ttext here", GIVEN) == "plain\ttext here"


def test_table_form(spark):
    v = spark.createDataFrame([("v1", "a\nx@post.example", "k"), ("v1", "a\nx@post.example", "k"), ("v2", None, "k"), (None, "", "k")], "version_id string, text_md string, kind string")
    e = spark.createDataFrame([("v1", "1", '{"quotes": ["no", "call +34 699 000 083", 5]}'), ("v1", "2", "{broken"), ("v2", "1", None), ("v3", "1", '["x"]')], "version_id string, prompt_version string, json string")
    p = spark.createDataFrame([("Zoé A",)] * 2 + [(None,)], "name string")
    got = sorted(map(tuple, pii.personal_information(v, e, p).collect()))
    assert got == [("quotes", "v1", "1", 1, "phone"), ("text_md", "v1", "", 1, "email")]
    assert pii.personal_information(v.limit(0), e.limit(0), p.limit(0)).count() == 0


def test_every_given_name_of_people_counts(spark):
    lines = "with Quirin Naskrud\nthen Ottoline Vask\nThe Garden\nMe Odette\nwe met Al Naskrud"
    v = spark.createDataFrame([("v1", lines), ("v2", "Odette Brun and her bees"), ("v3", None)], "version_id string, text_md string")
    e = spark.createDataFrame([("v1", "1", '{"quotes": ["saw Quirin Naskrud", "saw Nobody Naskrud"]}')], "version_id string, prompt_version string, json string")
    p = spark.createDataFrame([("Quirin A",), ("OTTOLINE B",), ("The House",), ("Al D",), ("Odette C",), (None,), ("Alone",)], "name string")
    assert {r["first"] for r in pii.given_names(p).collect()} == {"quirin", "ottoline", "odette", "the", "al"}
    want = [("quotes", "v1", "1", 0, "name"), ("text_md", "v1", "", 0, "name"), ("text_md", "v1", "", 1, "name"), ("text_md", "v1", "", 4, "name"), ("text_md", "v2", "", 0, "name")]
    assert sorted(map(tuple, pii.personal_information(v, e, p).collect())) == want
    assert sorted(map(tuple, pii.personal_information(v, e, p, most=1).collect())) == want  # more names than are sent along
    for most in (1, 10):
        rows, given = pii.with_given(v, "text_md", pii.given_names(p), most)
        got = {r["version_id"]: r["t"] for r in rows.select("version_id", pii.redacted(F.col("text_md"), given).alias("t")).collect()}
        assert got == {"v1": "with [NAME]\nthen [NAME]\nThe Garden\nMe Odette\nwe met [NAME]", "v2": "[NAME] and her bees", "v3": None}


# --- boilerplate -------------------------------------------------------------------------------------

PAGE = """**Amber Journal**
- [Home](/home)
- [About](/about)

This website uses cookies to improve your experience.
OK

# Now

We baked cookies for the whole street and I accept all compliments.
The footer of the house, as we call the cellar, is dry.

- mending a gate → [link](https://a.example/x)
- [reading about bees](https://b.example/log)

### Popular posts
- [Why I stopped mending gates](/2017/faseribi)
* October 2018 (2)

© 2016–2026 Zoé Naskesrud
Last updated: 2026-01-20"""


def test_furniture_and_main_text(spark):
    cols = "version_id string, url string, text_md string, host string, path string, score string"
    v = spark.createDataFrame([("v", "https://a.example/now", PAGE, "x", "x", "x")] * 2 + [("n", None, None, "x", "x", "x"), ("e", "https://a.example/now", " \n", "x", "x", "x"), ("w", None, "A line by itself that says something.\r\nOK\r", "x", "x", "x")], cols)
    got = {(r["version_id"], r["line_no"]) for r in boilerplate.furniture_lines(v).collect()}
    lines = PAGE.split("\n")
    assert {lines[n] for i, n in got if i == "v"} == {x for x in lines if x} - set(lines[7:14])
    assert {n for i, n in got if i == "w"} == {1} and not any(i in ("n", "e") for i, _ in got)
    text = {r["version_id"]: r["main_text"] for r in boilerplate.main_text(v).collect()}
    assert text["v"].startswith("# Now\n\nWe baked") and text["v"].endswith("[reading about bees](https://b.example/log)") and text["n"] is None and text["e"] == ""
    assert boilerplate.furniture_lines(v.limit(0)).count() == 0


def test_pages_of_a_host_decide(spark):
    frame = "Slow words from a small room by the sea, kept up since the spring of that year."
    steps = ["1. Please wipe your feet at the door before you come in.", "2. Please leave the lamp burning for whoever comes after you."]
    own = "I mended gate number {0} today and it took me all of the long morning."
    page = lambda k: "\n\n".join([own.format(k), frame, own.format(k + 100), *steps, f"3. Please say word {k} to the cat.", own.format(k + 200)])
    rows = [(f"s{k}", f"https://site.example/{k}", page(k)) for k in range(12)]
    rows += [(f"v{k}", "https://once.example/now", page(k)) for k in range(12)]  # versions of one page repeat what is the author's
    rows += [(f"m{k}", f"https://mirror.example/{k}", page(0)) for k in range(12)]  # and so do mirrors
    v = spark.createDataFrame(rows, "version_id string, url string, text_md string")
    got, alone = ({(r["version_id"], r["line_no"]) for r in boilerplate.furniture_lines(v, vote=vote).collect()} for vote in (True, False))
    # the frame and the steps repeat; the third step does not, but its path is furniture on this host
    assert got == {(f"s{k}", n) for k in range(12) for n in (2, 6, 8, 10)}
    assert alone == {(f"s{k}", n) for k in range(12) for n in (2, 6, 8)}  # by its own score it is a sentence of the author's


def test_frame_in_a_language_without_lists(spark):
    # Finnish: no word of it is in any list; of the frame's parts some recur on other hosts, some on none
    frame = ["Etusivu", "Päiväkirja", "Kuvat", "Vieraskirja", "Yhteys"]
    own = "Istutin tänään {0} omenapuuta pihan reunaan ja söin illalla keittoa."
    page = lambda h, k: "\n".join([*frame, f"Sivu {chr(97 + k)}{h}", "", own.format(k + 3), "", own.format(k + 50), "", *frame[::-1], f"Kone {chr(97 + k)}{h}"])
    rows = [(f"p{h:02d}{k}", f"https://h{h}.example/{k}", page(h, k)) for h in range(30) for k in range(2)]
    v = spark.createDataFrame(rows, "version_id string, url string, text_md string")
    got = {(r["version_id"], r["line_no"]) for r in boilerplate.furniture_lines(v).collect()}
    want = {(i, n) for i, _, t in rows for n, x in enumerate(t.split("\n")) if x and not x.startswith("Istutin")}
    assert got == want


# --- quality -----------------------------------------------------------------------------------------

DOCS = "doc_id bigint, text string, chars string, kind string, x string"


def test_kinds_of_documents(spark):
    common = spark.createDataFrame([(w,) for w in "the of and to a in is it for that we was on with but not this have i at be are as you or by from an what how most all if then rest would much der die und das ist nicht wir es ich den mit auf zu ein hat".split()] + [(None,)], "word string")
    prose = [t for c, t in quality.EXAMPLES if c == "prose"]
    rows = [(i, (t + " ") * 2 if len(t) < 80 else t) for i, t in enumerate(prose * 6)]
    rows = [(i, t if i % 6 else t + "\n\n| a | b |\n|---|---|") for i, t in rows]
    n = len(rows)
    bad = {n + k: t for k, t in enumerate(["| d | km |\n|---|---|\n| 2025-04-07 | 17.72 |\n| 2025-05-05 | 34.69 |", "1. Low Meadow (1968)\n2. Amber Gate (2018)\n3. North Field (2003)", "6812 31969 8011 938593 269 226930 95833 5560",
                                           "QmFz84Fmkmeu51373pKAgdHtzySxpe6Sa6qLwVra8dkjsvcJrSt1LqFnFd07cr9JkmmVmQUHykZw\nzoMqOAwVF", ".... >>> *~*~* ===== %% *~*~* ====="])}
    rows += list(bad.items()) + [(900, None), (901, " \n "), (None, "x")]
    df = spark.createDataFrame([(i, t, "c", "c", "c") for i, t in rows], DOCS)
    got = {r["doc_id"]: r["kind"] for r in quality.classified_documents(df, common).collect()}
    assert {i for i, k in got.items() if k != "prose"} == set(bad)
    assert got[n] == "table" and got[n + 1] == "list" and got[n + 2] in ("junk", "table")
    assert quality.classified_documents(df.limit(0), common).count() == 0


def test_mixture_is_fitted_by_expectation_maximisation(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, quality.D)) * 3
    x = np.vstack([c + rng.normal(size=(80, quality.D)) * 0.3 for c in centres])
    segs = spark.createDataFrame([(i, 100, v.tolist()) for i, v in enumerate(x)], quality.SEGMENTS)
    m = quality.fit_mixture(segs, frozenset(), frozenset(), 0.0)
    assert m.begun[-1] > m.begun[0] + 1 and all(b > a - 1e-2 for a, b in zip(m.begun, m.begun[1:]))  # the likelihood rises
    assert len(m.trace) >= 2 and m.trace[-1] - m.trace[-2] <= quality.TOLERANCE
    r, _ = m.expect(m.standardised(x))
    own = [set(r[k * 80 : k * 80 + 80].argmax(axis=1).tolist()) for k in range(5)]
    assert all(a.isdisjoint(b) for i, a in enumerate(own) for b in own[:i])  # no component has rows of two groups
    start = quality.Mixture(m.centre, m.spread, m.means + 1.0, m.variances, m.weights)
    w = np.ones(len(x))
    again = start.maximised(start.sums(start.standardised(x), w))
    far = lambda q: np.abs((q.expect(q.standardised(x))[0].sum(axis=0)[:, None] * (q.means - m.means)).sum())
    assert far(again) < far(start)  # means are free to move
    assert quality.fit_mixture(segs.limit(0), frozenset(), frozenset(), 0.0) is None


def test_statistics_of_documents(spark):
    common = spark.createDataFrame([("the",), ("The",)], "word string")
    df = spark.createDataFrame([(1, "The cat!\nno end"), (1, "The cat!\nno end"), (2, ""), (3, None), (4, "the " * 50_000)], "doc_id bigint, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in quality.quality_statistics(df, common).collect()}
    assert got[1] == (4, 2.75, round(1 / 15, 6), 0.5, 0.25) and got[2] == (0, 0.0, 0.0, 0.0, 0.0) and got[3] == (None,) * 5
    assert got[4][0] == 50_000 and got[4][4] == 1.0
