"""Per-document text statistics, and which documents are no running prose.

Each text is cut into segments, runs of lines that flow or runs of lines that are set in a pattern.
Their standardised statistics are fitted with a Gaussian mixture by expectation-maximisation: several
starts on a bounded sample, then steps over all segments of all documents, each one pass that returns
sums of a fixed size, until the likelihood no longer rises. Components are free; what each of them is
- prose, a list, a table or junk - is told afterwards by the inspected example that it takes for its
own most. A document is found if most of its characters lie in segments that are not prose.
"""

from __future__ import annotations

import math
import random
import re
import string
import textwrap
import warnings
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageatlas.session import durable

#: Statistics of a segment, in this order.
STATISTICS = ("log_words_a_line", "mean_word_length", "symbol_ratio", "digit_ratio", "punctuated_lines", "common_words", "coherence", "repeated_sentences", "repeated_words", "patterned", "case_breaks")
D = len(STATISTICS)
#: Components; starts, and segments of the sample they run on; a rise of the mean log-likelihood that no longer
#: counts, and steps after which a fit that still rises is given up on with a warning.
COMPONENTS, STARTS, SAMPLE, TOLERANCE, MOST_STEPS = 32, 12, 10_000, 1e-3, 100
#: Least standardised variance, and the weight, in segments, with which a variance starts from PRIOR.
FLOOR, PRIOR, PRIOR_WEIGHT = 0.05, 0.25, 30.0
#: Words of a window in which repetitions count.
WINDOW = 50
#: A pair of common words is usual if it occurs more often than by chance and in such a share of documents.
USUAL_PAIR = 5e-4

_WORD = re.compile(r"[^\W\d_]+")
_LEAD = re.compile(r"\s*(?:[-*+•·◦▪–—]\s|\(?\d{1,4}[.)]\s|\[[ xX]?\]|\||<[/!a-zA-Z]|[{}\[\]\"]|#{1,6}\s|\d{4}-\d\d-\d\d|https?://)")
_FIELDS = re.compile(r"(?:\s*\S+(?: \S+){0,2}\s*,){2,}\s*\S+(?: \S+){0,2}\s*$")
_KEY_VALUE = re.compile(r"\S{1,40}\s*[:=]\s*\S.{0,40}$")
_ALIGNED = re.compile(r"\S\s{3,}\S.*\s{3,}\S")
_DIGIT = re.compile(r"\d")
_SENTENCES = re.compile(r"[.!?…。！？]+[\"'”’)]*\s+|\n+")
_ENDS = re.compile(r"[.!?…:。！？][\"'”’)\]*_]*\s*(?:[☀-➿\U0001f300-\U0001faff]\s*)*$")
_BREAK = re.compile(r"[.!?]\s+(\w)")


def _patterned(line: str) -> bool:
    """Whether a line is set in a pattern: marked, tabular, or a key and its value."""
    return bool(
        _LEAD.match(line)
        or "\t" in line
        or line.count("|") > 1
        or line.count(";") > 2
        or ("   " in line and _ALIGNED.search(line))
        or ("," in line and _FIELDS.match(line))
        or (len(line) < 130 and _KEY_VALUE.match(line))
    )


def segments(text: str | None) -> list[tuple[str, float]]:
    """(run of non-blank lines, share of them that are patterned), cut where flowing and patterned lines meet."""
    out: list[list[str]] = []
    marks: list[int] = []
    kind = None
    for line in (text or "").splitlines():
        if not line.strip():
            continue
        words = len(line.split())
        p = _patterned(line)
        k = p or (words < 5 and not _ENDS.search(line) and (kind is not False or words < 2))
        if out and k == kind:
            out[-1].append(line)
            marks[-1] += p
        else:
            out.append([line])
            marks.append(int(p))
        kind = k
    return [("\n".join(x), m / len(x)) for x, m in zip(out, marks)]


def _repeated(words: list[str]) -> float:
    """Share of words that stand earlier in their window, so that it doesn't grow with the text."""
    if len(words) < 10:
        return 0.0
    windows = [words[i : i + WINDOW] for i in range(0, max(1, len(words) - WINDOW // 2), WINDOW)]
    return sum(1 - len(set(w)) / len(w) for w in windows) / len(windows)


def statistics(text: str, common: frozenset[str], usual: frozenset[tuple[str, str]] | None, patterned: float | None = None) -> list[float]:
    """STATISTICS of one segment or text."""
    lines = [x for x in text.splitlines() if x.strip()] or [text]
    low = text.lower()
    words = _WORD.findall(low)
    n = max(len(words), 1)
    chars = max(len(text) - text.count(" ") - text.count("\n"), 1)
    digits = len(_DIGIT.findall(text))
    letters = sum(map(len, words))
    known = [w in common for w in words]
    pairs = good = 0
    if usual:
        both = [(a, b) for a, b, x, y in zip(words, words[1:], known, known[1:]) if x and y]
        pairs, good = len(both), sum(map(usual.__contains__, both))
    sentences = [s.strip() for s in _SENTENCES.split(text) if s.strip()]
    breaks = [c.islower() for c in _BREAK.findall(text)]
    return [
        math.log1p(len(text.split()) / len(lines)),
        min(letters / n, 20.0) if words else 0.0,
        max(chars - letters - digits, 0) / chars,
        digits / chars,
        sum(bool(_ENDS.search(x[-60:])) for x in lines) / len(lines),
        sum(known) / n,
        (good + 2.0) / (pairs + 2.5),
        1 - len(set(sentences)) / len(sentences) if len(sentences) > 3 else 0.0,
        _repeated(words),
        sum(map(_patterned, lines)) / len(lines) if patterned is None else patterned,
        (sum(breaks) + 0.05) / (len(breaks) + 1.0),
    ]


def usual_pairs(documents: DataFrame, common: frozenset[str]) -> tuple[frozenset[tuple[str, str]], float]:
    """Pairs of neighbouring common words that occur together more often than by chance, and how often
    words in no order would make one of them.

    Counted once a document over all documents; the result has at most |common|² pairs, as many as
    come to the driver at most.
    """

    def count(batches):
        total: Counter = Counter()
        n = 0
        for b in batches:
            for t in b.column("text").to_pylist():
                n += 1
                words = _WORD.findall((t or "").lower())
                known = [w in common for w in words]
                total.update({(a, c) for a, c, x, y in zip(words, words[1:], known, known[1:]) if x and y})
        rows = [(a, c, k) for (a, c), k in total.items()] + [("", "", n)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["a", "b", "n"])

    got = documents.select("text").mapInArrow(count, "a string, b string, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
    n = {(r["a"], r["b"]): r["n"] for r in got}
    docs = n.pop(("", ""), 0)
    left, right = Counter(), Counter()
    for (a, b), k in n.items():
        left[a] += k
        right[b] += k
    whole = max(sum(n.values()), 1)
    usual = frozenset(p for p, k in n.items() if k >= max(2, USUAL_PAIR * docs) and k * whole > left[p[0]] * right[p[1]])
    return usual, sum(left[a] * right[b] for a, b in usual) / whole**2


#: Inspected texts from which the examples come. Our own words, on everyday matters, in languages with and without common words.
PROSE_TEXTS = {
    "en": "My sister came to stay in March, and we spent most of the visit on the tram, riding it to the end of the line and back. She had never seen the river so high. I told her about the choir, which is still looking for a tenor, and about the kettle that whistles a minor third. When she left I was sad for a day or two. Then the tax letter came, and there was no time to be sad. I have been sleeping well. If you would like to write to me, I would be glad, but do not expect a quick answer, because I am slow at this and always have been.",
    "de": "Meine Schwester war im März zu Besuch, und wir sind die meiste Zeit mit der Straßenbahn gefahren, bis zur letzten Haltestelle und wieder zurück. Sie hatte den Fluss noch nie so hoch gesehen. Ich habe ihr vom Chor erzählt, der immer noch einen Tenor sucht, und von dem Kessel, der in Moll pfeift. Als sie weg war, war ich ein paar Tage traurig. Dann kam der Brief vom Amt, und für Trauer war keine Zeit mehr. Ich schlafe wieder gut. Wenn du mir schreiben willst, freue ich mich, aber erwarte keine schnelle Antwort, denn darin bin ich langsam und war es schon immer.",
    "fr": "Ma sœur est venue en mars, et nous avons passé presque tout son séjour dans le tram, jusqu'au terminus et retour. Elle n'avait jamais vu le fleuve aussi haut. Je lui ai parlé de la chorale, qui cherche encore un ténor, et de la bouilloire qui siffle en mineur. Quand elle est partie, j'ai été triste un jour ou deux. Puis la lettre des impôts est arrivée, et je n'avais plus le temps d'être triste. Je dors bien de nouveau. Si vous voulez m'écrire, j'en serai heureux, mais n'attendez pas une réponse rapide, car je suis lent et je l'ai toujours été.",
    "es": "Mi hermana vino en marzo, y pasamos casi toda la visita en el tranvía, hasta el final de la línea y de vuelta. Nunca había visto el río tan alto. Le hablé del coro, que todavía busca un tenor, y de la tetera que silba en tono menor. Cuando se fue estuve triste un par de días. Luego llegó la carta de Hacienda, y ya no hubo tiempo para estar triste. Vuelvo a dormir bien. Si quieres escribirme, me alegro mucho, pero no esperes una respuesta rápida, porque soy lento para esto y siempre lo he sido.",
    "nl": "Mijn zus kwam in maart logeren en we zaten bijna het hele bezoek in de tram, tot het eind van de lijn en weer terug. Ze had de rivier nog nooit zo hoog gezien. Ik vertelde haar over het koor, dat nog steeds een tenor zoekt, en over de ketel die in mineur fluit. Toen ze weg was, was ik een paar dagen verdrietig. Daarna kwam de brief van de belasting en was er geen tijd meer om verdrietig te zijn. Ik slaap weer goed. Als je me wilt schrijven vind ik dat fijn, maar verwacht geen snel antwoord, want daar ben ik traag in en dat was ik altijd al.",
    "it": "Mia sorella è venuta a marzo e abbiamo passato quasi tutta la visita sul tram, fino al capolinea e ritorno. Non aveva mai visto il fiume così alto. Le ho parlato del coro, che cerca ancora un tenore, e del bollitore che fischia in minore. Quando è partita sono stato triste per un giorno o due. Poi è arrivata la lettera delle tasse e non c'era più tempo per essere triste. Dormo di nuovo bene. Se vuoi scrivermi mi fa piacere, ma non aspettarti una risposta veloce, perché sono lento in queste cose e lo sono sempre stato.",
    "pl": "Moja siostra przyjechała w marcu i prawie cały pobyt spędziliśmy w tramwaju, do końca linii i z powrotem. Nigdy nie widziała rzeki tak wysokiej. Opowiedziałem jej o chórze, który wciąż szuka tenora, i o czajniku, który gwiżdże w tonacji molowej. Kiedy wyjechała, przez dzień czy dwa było mi smutno. Potem przyszedł list z urzędu i nie było już czasu na smutek. Znowu dobrze śpię. Jeśli chcesz do mnie napisać, będzie mi miło, ale nie oczekuj szybkiej odpowiedzi, bo jestem w tym powolny i zawsze byłem.",
}
#: Function words of four languages.
FUNCTION_WORDS = {
    "en": "of the was so in have but they what into some been we this not with for because over an be a their more and also i to from were has can",
    "de": "und ist so wir hat ein nicht doch für durch es vor wird in da über von wenn zur sehr aus sein unter aber nun hatte nach wie sind dann das",
    "fr": "de la et les des en un une que qui dans pour pas sur au avec ce il sont mais nous par plus ou son je se elle cette tout",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más pero sus le ya este sí porque",
}


def _examples() -> list[tuple[str, str]]:
    """(kind, text): texts as they are, and what rules make of them."""
    rng = random.Random(1)
    syllables = [c + v for c in "bdfgjklmnprstvz" for v in "aeiou"]
    out = []
    for lang, text in PROSE_TEXTS.items():
        sentences = re.split(r"(?<=\.) ", text)
        bare = re.sub(r"[.,]", "", text).lower()
        out += [("prose", text), ("prose", text + "\n" + " ".join(sentences[::-1]) + "\n" + " ".join(sentences[2:] + sentences[:2])), ("prose", " ".join(sentences[2:5])), ("prose", sentences[1]), ("prose", sentences[0])]
        out += [("prose", bare), ("prose", sentences[0] + " " + re.sub(r"[.,]", "", " ".join(sentences[1:5])).lower())]
        out.append(("prose", "\n".join(textwrap.wrap(text, 52))))
        words = text.split()
        plain = [re.sub(r"[.,]", "", w) for w in words]
        ends = [w[-1] if w[-1] in ".," else "" for w in words]
        for _ in range(3):
            rng.shuffle(plain)
            out.append(("shuffled", " ".join(w + e for w, e in zip(plain, ends))))
        out.append(("loop", (sentences[1] + " ") * 8))
        out.append(("loop", (sentences[5] + "\n") * 9))
        nouns = [w for w in plain if len(w) > 3][:18]
        some = lambda k: rng.sample(nouns, k)
        out.append(("list", "\n".join(f"- {' '.join(some(2)).lower()}" for _ in range(6))))
        for mark in ("{}. ", "{}) ", "- "):
            out.append(("list", "\n".join(f"{mark.format(i)}{some(1)[0].title()} {some(1)[0]} ({rng.randint(1950, 2024)})" for i in range(1, 7))))
        out.append(("list", "\n".join(f"[{rng.choice('x ')}] {' '.join(some(3)).lower()}" for _ in range(5))))
        out.append(("list", "\n".join(w.title() for w in some(12))))
        out.append(("list", "\n".join(", ".join(some(3)) for _ in range(5))))
        out.append(("list", "\n".join(f"• {some(1)[0].title()} – {some(1)[0].title()}" for _ in range(5))))
        out.append(("list", "\n".join(f"({i}) {some(1)[0].title()}: {' '.join(some(4)).lower()}" for i in range(1, 5))))
        out.append(("shuffled list", "\n".join(f"- {' '.join(rng.sample(plain, 5)).lower()}" for _ in range(5))))
        day = lambda: f"20{rng.randint(10, 25)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"
        number = lambda: f"{rng.randint(1, 999) / 10:.2f}"
        out.append(("table", "| day | what | how |\n|---|---|---|\n" + "\n".join(f"| {day()} | {some(1)[0]} | {number()} |" for _ in range(4))))
        out.append(("table", "\n".join(f"{day()};{some(1)[0]};{rng.randint(1, 90)};{number()};{rng.randint(1, 300)}" for _ in range(5))))
        out.append(("table", "\n".join(f"{day()}\t{some(1)[0]}\t{rng.randint(1, 90)}\t{number()}" for _ in range(5))))
        out.append(("table", "\n".join(f"{some(1)[0]:<14}{rng.randint(1, 90):>6}{number():>10}{number():>10}" for _ in range(5))))
        out.append(("table", "\n".join(f"{some(1)[0]}: {rng.randint(1, 90)} / {rng.randint(1, 90)} / {number()} kg" for _ in range(5))))
        out.append(("junk", "\n".join(f"{day()} {rng.randint(10, 23)}:{rng.randint(10, 59)} ERROR [{some(1)[0]}] id={rng.randint(1, 9999)} at 0x{rng.getrandbits(32):08x}" for _ in range(3))))
        out.append(("junk", "\n".join(f'<p class="{some(1)[0]}-{rng.randint(1, 99)}"><i data="/{some(1)[0]}">{{{{ {some(1)[0]} }}}}</i></p>' for _ in range(3))))
        out.append(("junk", " ".join(f"{rng.choice(['top', 'cheap', 'free', 'online'])} {a}, {a} {b}," for a, b in (some(2) for _ in range(9)))))
        out.append(("junk", "".join(rng.choice(["Ã©", "Ã¤", "â€™", "&amp;", "&nbsp;", "�", "ï»¿", "Â ", "\\u00", some(1)[0]]) for _ in range(50))))
        for least in (1, 2):
            babble = ["".join(rng.choices(syllables, k=rng.randint(least, 4))) + rng.choice(["", "", "n", "r"]) for _ in range(72)]
            out.append(("junk", " ".join(f"{' '.join(babble[i : i + 9]).capitalize()}{rng.choice('..?,')}" for i in range(0, 72, 9))))
        out.append(("junk", " ".join(str(rng.getrandbits(rng.randint(3, 27))) for _ in range(25))))
        out.append(("junk", "\n".join("".join(rng.choices(string.ascii_letters + string.digits + "+/", k=76)) for _ in range(2))))
        out.append(("junk", " ".join(rng.choice(["....", ">>>", "*~*~*", "=====", "%%", "|||", "//--//", "$$", "###"]) for _ in range(30))))
    for words in FUNCTION_WORDS.values():
        for _ in range(2):
            out.append(("shuffled", " ".join(rng.choices(words.split(), k=60)) + "."))
    return out


#: Inspected examples: (kind, text).
EXAMPLES = _examples()
CLASSES = ("prose", "list", "table", "junk")
VOTES = (1.3, 1.1, 1.0, 0.9, 0.8)
CLASS_OF = {"prose": 0, "list": 1, "shuffled list": 1, "table": 2}


class Mixture:
    """Means, variances and weights of the components over standardised statistics, the class of each, and
    the mean log-likelihood before each step of the fit, over all rows and (``begun``) over the sample."""

    def __init__(self, centre, spread, means, variances, weights, classes=None, trace=()):
        self.centre, self.spread = centre, spread
        self.means, self.variances, self.weights, self.classes, self.trace, self.begun = means, variances, weights, classes, list(trace), []

    def plain(self) -> tuple:
        return self.centre, self.spread, self.means, self.variances, self.weights, self.classes

    def standardised(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.spread, -8, 8)

    def log_density(self, z: np.ndarray) -> np.ndarray:
        """Per row and component, weights left out."""
        by = 1.0 / self.variances
        own = (self.means**2 * by + np.log(self.variances)).sum(axis=1)
        return -0.5 * ((z * z) @ by.T - 2.0 * z @ (self.means * by).T + own[None])

    def expect(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(responsibilities, log-likelihoods) of the rows."""
        d = self.log_density(z) + np.log(self.weights)[None]
        top = d.max(axis=1, keepdims=True)
        r = np.exp(d - top)
        s = r.sum(axis=1, keepdims=True)
        return r / s, (top + np.log(s))[:, 0]

    def sums(self, z: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Per component its weight, weighted sum, sum of squares; and, in the first row, the log-likelihood."""
        out = np.zeros((len(self.weights), 2 + 2 * D))
        for lo in range(0, len(z), 4_096):
            part = z[lo : lo + 4_096]
            r, ll = self.expect(part)
            r = r * w[lo : lo + 4_096, None]
            out[:, 1:] += np.hstack([r.sum(axis=0)[:, None], r.T @ part, r.T @ (part * part)])
            out[0, 0] += ll @ w[lo : lo + 4_096]
        return out

    def maximised(self, total: np.ndarray) -> Mixture:
        n = np.maximum(total[:, 1:2], 1e-9)
        means = total[:, 2 : 2 + D] / n
        own = np.maximum(total[:, 2 + D :] / n - means**2, 0.0)
        variances = np.maximum((n * own + PRIOR_WEIGHT * PRIOR) / (n + PRIOR_WEIGHT), FLOOR)
        out = Mixture(self.centre, self.spread, means, variances, n[:, 0] / n.sum(), self.classes, [*self.trace, total[0, 0] / n.sum()])
        out.begun = self.begun
        return out


def _rises(trace: list[float]) -> bool:
    return len(trace) < 2 or trace[-1] - trace[-2] > TOLERANCE


def _start(centre: np.ndarray, spread: np.ndarray, x: np.ndarray, w: np.ndarray) -> Mixture:
    """The likeliest of several fits to a sample, each from components far apart."""
    best: Mixture | None = None
    for seed in range(STARTS):
        rng = np.random.default_rng(seed)
        m = Mixture(centre, spread, None, None, None)
        z = m.standardised(x)
        means = z[[rng.integers(len(z))]]
        far = ((z - means) ** 2).sum(axis=1)
        while len(means) < COMPONENTS and far.sum() > 0:
            j = rng.choice(len(z), p=far / far.sum())
            means = np.vstack([means, z[j]])
            far = np.minimum(far, ((z - z[j]) ** 2).sum(axis=1))
        m.means, m.variances, m.weights = means, np.full(means.shape, 0.5), np.full(len(means), 1 / len(means))
        while _rises(m.trace) and len(m.trace) < MOST_STEPS:
            m = m.maximised(m.sums(z, w))
        if best is None or m.trace[-1] > best.trace[-1]:
            best = m
    best.begun, best.trace = best.trace, []
    return best


def example_statistics(common: frozenset[str], usual: frozenset[tuple[str, str]], chance: float, coherence: float) -> np.ndarray:
    """STATISTICS of the examples. Which pairs of words are usual depends on the corpus and not on the few of
    an example, so those in order have the corpus's mean coherence, and shuffled ones that of chance."""
    out, at = np.array([statistics(t, common, usual) for _, t in EXAMPLES]), STATISTICS.index("coherence")
    for i, (kind, _) in enumerate(EXAMPLES):
        if kind in ("prose", "loop"):
            out[i, at] = coherence
        elif kind.startswith("shuffled"):
            out[i, at] = chance
    return out


SEGMENTS = "doc_id bigint, chars bigint, x array<double>"


def segment_statistics(documents: DataFrame, common: frozenset[str], usual: frozenset[tuple[str, str]]) -> DataFrame:
    """(doc_id, chars, x): one row per segment of every non-blank text."""

    def run(batches):
        for b in batches:
            ids, chars, flat = [], [], []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                for s, patterned in segments(t):
                    ids.append(i)
                    chars.append(len(s))
                    flat.extend(statistics(s, common, usual, patterned))
            x = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, D), pa.int32()), pa.array(flat, pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(chars, pa.int64()), x], names=["doc_id", "chars", "x"])

    return documents.select("doc_id", "text").where(F.length("text") > 0).mapInArrow(run, SEGMENTS)


def _rows(b: pa.RecordBatch) -> np.ndarray:
    return np.asarray(b.column("x").flatten()).reshape(-1, D)


def fit_mixture(segs: DataFrame, common: frozenset[str], usual: frozenset[tuple[str, str]], chance: float) -> Mixture | None:
    """Expectation-maximisation over all segments, weighted by the logarithm of their characters.

    The starts run on about SAMPLE segments, drawn by hash; then every step takes all segments, until
    the mean log-likelihood rises by no more than TOLERANCE. The examples take part as rows like any other,
    so that small tables have components for kinds that they lack. None without segments.
    """

    def moments(batches):
        s = np.zeros((3, D))
        for b in batches:
            x, w = _rows(b), np.log1p(np.asarray(b.column("chars"), dtype=float))[:, None]
            s += np.vstack([(w * x).sum(axis=0), (w * x * x).sum(axis=0), np.full(D, w.sum())])
        yield pa.RecordBatch.from_arrays([pa.array(range(D), pa.int32()), *map(pa.array, s)], names=["k", "a", "b", "w"])

    got = segs.mapInArrow(moments, "k int, a double, b double, w double").groupBy("k").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("w").alias("w")).collect()
    centre, spread = np.zeros(D), np.ones(D)
    for r in got:
        if r["w"]:
            centre[r["k"]] = r["a"] / r["w"]
            spread[r["k"]] = math.sqrt(max(r["b"] / r["w"] - centre[r["k"]] ** 2, 1e-4))
    drawn = segs.orderBy(F.xxhash64("doc_id", "chars", "x"), "doc_id").limit(SAMPLE).select("chars", "x").toArrow()  # bounded: SAMPLE
    if not drawn.num_rows:
        return None
    shown = example_statistics(common, usual, chance, centre[STATISTICS.index("coherence")])
    shown_w = np.log1p([float(len(t)) for _, t in EXAMPLES])
    x = np.asarray(drawn["x"].combine_chunks().flatten()).reshape(-1, D)
    m = _start(centre, spread, np.vstack([x, shown]), np.concatenate([np.log1p(np.asarray(drawn["chars"], dtype=float)), shown_w]))
    z, k = m.standardised(shown), len(m.weights)
    while _rises(m.trace):
        if len(m.trace) == MOST_STEPS:
            warnings.warn(f"the mixture still rises after {MOST_STEPS} steps: {m.trace[-2:]}", stacklevel=2)
            break
        plain = m.plain()

        def expect(batches, plain=plain):
            mix, s = Mixture(*plain), np.zeros((k, 2 + 2 * D))
            for b in batches:
                s += mix.sums(mix.standardised(_rows(b)), np.log1p(np.asarray(b.column("chars"), dtype=float)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(k), pa.int32()), pa.ListArray.from_arrays(pa.array(np.arange(k + 1) * s.shape[1], pa.int32()), pa.array(s.ravel()))], names=["k", "s"]
            )

        total = m.sums(z, shown_w)
        sums = [F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(total.shape[1])]
        for r in segs.mapInArrow(expect, "k int, s array<double>").groupBy("k").agg(*sums).collect():  # one row per component
            total[r["k"]] += [r[f"s{i}"] for i in range(total.shape[1])]
        m = m.maximised(total)
    m.classes = _named(m, z)
    return m


def _named(m: Mixture, shown: np.ndarray) -> np.ndarray:
    """The class of each component: that of most of the five examples likeliest under it, the likelier counting more."""
    of = np.array([CLASS_OF.get(c, 3) for c, _ in EXAMPLES])
    nearest = of[(-m.log_density(shown)).argsort(axis=0)[: len(VOTES)]]
    return np.stack([(np.array(VOTES)[:, None] * (nearest == c)).sum(axis=0) for c in range(len(CLASSES))]).argmax(axis=0)


def classified_documents(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """(doc_id, kind, prose_share): kind is prose, list, table or junk; prose_share the share of the
    text's characters in segments of prose.

    A document is prose unless less than half of its characters are; else the class with the most
    characters. Null and blank texts have no row. Texts are read whole; duplicates of a doc_id count
    once. ``common_words`` is a word list of bounded size.
    """
    common = frozenset(r["word"].lower() for r in common_words.select("word").where("word is not null").distinct().collect())
    docs = documents.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("text").alias("text"))
    usual, chance = usual_pairs(docs, common)
    segs = durable(segment_statistics(docs, common, usual))
    m = fit_mixture(segs, common, usual, chance)
    plain = m.plain() if m else None  # without segments no batch needs one

    def assign(batches):
        for b in batches:
            if not b.num_rows:
                continue
            mix = Mixture(*plain)
            r, _ = mix.expect(mix.standardised(_rows(b)))
            share = np.stack([r[:, mix.classes == c].sum(axis=1) for c in range(4)], axis=1)
            kind = np.where(share[:, 0] >= 0.5, 0, share[:, 1:].argmax(axis=1) + 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("chars"), pa.array(kind.astype(np.int32))], names=["doc_id", "chars", "kind"])

    per = segs.mapInArrow(assign, "doc_id bigint, chars bigint, kind int").groupBy("doc_id").agg(
        F.sum("chars").alias("n"), *[F.sum(F.when(F.col("kind") == i, F.col("chars")).otherwise(0)).alias(c) for i, c in enumerate(CLASSES)]
    )
    most = F.when(F.col("prose") * 2 >= F.col("n"), "prose").when((F.col("list") >= F.col("table")) & (F.col("list") >= F.col("junk")), "list").when(F.col("table") >= F.col("junk"), "table").otherwise("junk")
    return per.select("doc_id", most.alias("kind"), F.round(F.col("prose") / F.col("n"), 4).alias("prose_share"))


def document_statistics(text: Column, common_words: Column) -> Column:
    """struct(n_words, mean_word_length, symbol_ratio, punctuated_lines, common_share) with built-in
    functions only. ``common_words``: an array literal. Null text gives null; a text without words
    has lengths and shares of 0."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{M}]+)"), 1)
    n = F.size(words)
    letters = F.aggregate(words, F.lit(0), lambda a, w: a + F.length(w))
    lines = F.filter(F.split(text, r"\r\n|[\n\r]"), lambda x: F.length(F.trim(x)) > 0)
    ended = F.size(F.filter(lines, lambda x: F.rtrim(x).rlike(r"[.!?…:]$")))
    symbols = F.length(F.regexp_replace(text, r"[\p{L}\p{M}\p{N}\s]", ""))
    ratio = lambda a, b: F.round(F.coalesce(a / F.when(b > 0, b), F.lit(0.0)), 6)
    return F.when(
        text.isNotNull(),
        F.struct(
            n.cast("bigint").alias("n_words"),
            ratio(letters, n).alias("mean_word_length"),
            ratio(symbols, F.length(text)).alias("symbol_ratio"),
            ratio(ended, F.size(lines)).alias("punctuated_lines"),
            ratio(F.size(F.filter(words, lambda w: F.array_contains(common_words, w))), n).alias("common_share"),
        ),
    )


def quality_statistics(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """(doc_id, n_words, mean_word_length, symbol_ratio, punctuated_lines, common_share), each document
    once; a null text has null statistics."""
    words = sorted(r["word"].lower() for r in common_words.select("word").where("word is not null").distinct().collect())
    listed = F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")
    docs = documents.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("text").alias("text"))
    return docs.select("doc_id", document_statistics(F.col("text"), listed).alias("s")).select("doc_id", "s.*")
