"""Personal information inside free text: find it, and put typed placeholders in its place.

A line is first rewritten by small transducers that undo disguises (look-alike letters, decomposed
and invisible characters, written-out ``at`` and ``dot``, spelled digits). Each keeps the offsets
of what it replaces, so that identifiers found in the rewritten line are mapped back to the exact
characters of the source and only those are replaced.
"""

from __future__ import annotations

import bisect
import json
import re
import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageatlas.functions.arrow import arrow_function
from pageatlas.session import durable

KINDS = ("email", "phone", "id_number", "address", "name")

#: Letters of other alphabets that look like Latin ones.
LOOKALIKES = str.maketrans(
    "АВЕКМНОРСТХаеорсухіјѕһԁɡ＠．－＋０１２３４５６７８９‐‑‒    　\t",
    "ABEKMHOPCTXaeopcyxijshdg@.-+0123456789---      ",
)
#: Spelled digits of four languages.
SPELLED = {
    w: str(d)
    for d, words in enumerate(
        [
            "zero oh null zéro cero", "one eins un une uno", "two zwei zwo deux dos", "three drei trois tres", "four vier quatre cuatro",
            "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete", "eight acht huit ocho", "nine neun neuf nueve",
        ]
    )
    for w in words.split()
}
_DIGIT_WORDS = "|".join(sorted(SPELLED, key=len, reverse=True))
_AT = r"at|ät|arroba|arobase|chez|bei|à"
_DOT = r"dot|punto|point|punkt|pt"

#: Transducers: (what they look for, what it becomes), in the order in which they run.
TRANSDUCERS = [
    (re.compile(r"[​-‍⁠﻿­]+"), ""),
    (re.compile(r"&#0*64;|&#x0*40;|&commat;", re.I), "@"),
    (re.compile(r"&#0*46;|&#x0*2e;|&period;", re.I), "."),
    (re.compile(rf"(?<=[\w+-])\s*[\[({{<|*_]+\s*(?:{_AT}|@)\s*[\])}}>|*_]+\s*(?=[\w-])", re.I), "@"),
    (re.compile(rf"(?<=\w)\s*[\[({{<|*]+\s*(?:{_DOT}|\.)\s*[\])}}>|*]+\s*(?=\w)", re.I), "."),
    (re.compile(rf"(?<=[\w+-])\s+(?:at|ät|arroba|arobase|chez|bei)\s+(?=[\w-]+(?:\s+(?:{_DOT})\s+|\.)[\w-]+(?:(?:\s+(?:{_DOT})\s+|\.)[\w-]+)*\b)", re.I), None),
    (re.compile(rf"(?<=@)([\w-]+(?:(?:\s+(?:{_DOT})\s+|\.)[\w-]+)+)", re.I), None),
    (re.compile(r"(?<=\w)\s+@\s+(?=[\w-]+\s*\.)|(?<=\w)\s+@(?=[\w-]+\.)"), "@"),
    (re.compile(rf"\b(?:{_DIGIT_WORDS})(?:[\s,-]+(?:{_DIGIT_WORDS})){{5,}}\b", re.I), None),
]
#: What a line must have for a transducer to apply, as tests that cost little. Each follows from a
#: transducer's own pattern: a guard that asks for more than they do hides what they are for.
_ODD_CHARACTER = re.compile(r"[^\x00-\x7fÀ-ſ–—’·]")
_BRACKETED = re.compile(rf"[\[({{<|*_]\s*(?:{_AT}|@|{_DOT}|\.)\s*[\])}}>|*_]", re.I)
_SPOKEN_AT_WORDS = frozenset("at ät arroba arobase chez bei".split())
_SPOKEN_AT = re.compile(rf"\s(?:at|ät|arroba|arobase|chez|bei)\s+[\w-]+(?:\s+(?:{_DOT})\s|\.[\w-])", re.I)


def _low(text: str) -> str:
    """Lower case in which the letters that patterns without case take for i and s are these."""
    return text.lower() if text.isascii() else text.lower().replace("i̇", "i").replace("ı", "i").replace("ſ", "s")


def _may_need(text: str, low: str) -> bool:
    if "@" in low or "&#" in low or "&commat;" in low or "&period;" in low or _BRACKETED.search(text):
        return True
    words = low.replace(",", " ").replace("-", " ").split()
    if not _SPOKEN_AT_WORDS.isdisjoint(words) and _SPOKEN_AT.search(text):
        return True
    run = 0
    for w in words:  # of six spelled digits in a row the inner four stand alone
        run = run + 1 if w in SPELLED else 0
        if run > 3:
            return True
    return False


_MAILBOX = re.compile(r"[._+\d-]")
_DOT_WORD = re.compile(rf"\s+(?:{_DOT})\s+", re.I)


class Rewritten:
    """A text after transducers, with the way back: ``spans`` of equal pieces (at, source, length)."""

    def __init__(self, source: str):
        self.text = source
        self._at, self._src = [0], [0]
        self._end = len(source)

    def back(self, i: int) -> int:
        """Where position ``i`` of the rewritten text begins in the source."""
        k = bisect.bisect_right(self._at, i) - 1
        limit = self._src[k + 1] if k + 1 < len(self._src) else self._end
        return min(self._src[k] + i - self._at[k], limit)

    def span(self, start: int, end: int) -> tuple[int, int]:
        return self.back(start), (self.back(end - 1) + 1 if end > start else self.back(start)) if not self._cut(end) else self.back(end)

    def _cut(self, i: int) -> bool:
        """Whether a replaced piece ends at ``i``."""
        k = bisect.bisect_left(self._at, i)
        return k < len(self._at) and self._at[k] == i

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace [start, end) by a string for each edit, in order and without overlaps."""
        if not edits:
            return
        out, at, src, pos = [], [], [], 0
        n = 0

        def copy(lo: int, hi: int) -> None:
            nonlocal n
            if hi <= lo:
                return
            k = bisect.bisect_right(self._at, lo) - 1
            at.append(n)
            src.append(self.back(lo))
            for j in range(k + 1, len(self._at)):
                if self._at[j] >= hi:
                    break
                at.append(n + self._at[j] - lo)
                src.append(self._src[j])
            out.append(self.text[lo:hi])
            n += hi - lo

        for s, e, new in edits:
            copy(pos, s)
            if new:
                at.append(n)
                src.append(self.back(s))
                out.append(new)
                n += len(new)
            pos = e
            at.append(n)
            src.append(self.back(e))
        copy(pos, len(self.text))
        self.text, self._at, self._src = "".join(out), at, src


def rewrite(line: str) -> Rewritten:
    """Undo the disguises of one line."""
    r = Rewritten(line)
    if line.isascii() or not _ODD_CHARACTER.search(line):
        return _undo(r) if _may_need(line, _low(line)) else r
    r.text = line.translate(LOOKALIKES)
    if not unicodedata.is_normalized("NFC", r.text):
        r.apply(
            [
                (m.start(), m.end(), c)
                for m in re.finditer(r"[^\W\d_][̀-ͯ]+", r.text)
                if (c := unicodedata.normalize("NFC", m.group())) != m.group()
            ]
        )
    return _undo(r)


def _undo(r: Rewritten) -> Rewritten:
    for k, (pattern, new) in enumerate(TRANSDUCERS):
        edits = []
        for m in pattern.finditer(r.text):
            if new is not None:
                edits.append((m.start(), m.end(), new))
            elif k == 5:  # a bare "at": its host says dot in words, or what stands before looks like a mailbox
                local = re.search(r"[\w.+-]+$", r.text[: m.start()])
                host = re.match(rf"[\w-]+\s+(?:{_DOT})\s", r.text[m.end() :], re.I)
                if local and (host or (m.group().strip().lower() == "at" and _MAILBOX.search(local.group()))):
                    edits.append((m.start(), m.end(), "@"))
            elif k == 6:
                edits.extend((m.start() + d.start(), m.start() + d.end(), ".") for d in _DOT_WORD.finditer(m.group()))
            else:
                edits.append((m.start(), m.end(), "".join(SPELLED[_low(w)] for w in re.findall(r"[^\W\d_]+", m.group()))))
        r.apply(edits)
    return r


EMAIL = re.compile(r"(?<![\w@/.])[\w+][\w.+%'-]*@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}\b")

# --- numbers -------------------------------------------------------------------------------------

#: What numbers of persons are called in four languages.
ID_WORDS = (
    r"passports?|passeport|pasaporte|reisepass(?:nummer)?|pass-?nr|personalausweis(?:nummer)?|ausweis(?:nummer|-?nr)?|identity card|id card|national id|"
    r"carte (?:nationale )?d['’]identité|cni|cin|dni|nie|nif|documento (?:nacional )?de identidad|cédula|"
    r"driv(?:ing|er['’]?s?) licen[cs]e|licen[cs]e (?:no|number|nr)|führerschein(?:nummer)?|permis(?: de conduire)?|(?:carnet|permiso|licencia) de conducir|"
    r"social security(?: (?:no|number))?|ssn|national insurance(?: (?:no|number))?|ni (?:no|number)|nino|sécurité sociale|nir|numéro de sécu|seguridad social|nss|"
    r"sozialversicherungs(?:nummer|-?nr)|rentenversicherungsnummer|sv-?nummer|tax (?:id|no|number|file number)|taxpayer(?: identification)?(?: number)?|tin|itin|"
    r"steuer-?id(?:nr)?|steuer(?:nummer|-?nr)|steueridentifikationsnummer|idnr|numéro fiscal|nº fiscal|número fiscal|identificación fiscal|spi"
)
ID_BY_WORD = re.compile(
    rf"(?<!\w)(?:{ID_WORDS})(?!\w)[^\d\n]{{0,24}}?(?P<v>(?-i:(?<![^\W_])[A-Z]{{0,4}}[ -]?\d(?:[\dA-Z]|[ ./-](?=[\dA-Z](?![a-z]))){{4,24}}(?![a-zà-ÿ])))", re.I
)
ID_BY_SHAPE = re.compile(
    r"(?<![\w.-])(?:\d{3}-\d{2}-\d{4}|[A-Z]{2}(?: ?\d{2}){3} ?[A-D]|[XYZ]-?\d{7}-?[A-Z]|\d{2}\.\d{3}\.\d{3}-?[A-Z]|\d{8}-?[A-HJ-NP-TV-Z])(?![\w-])"
)
_DATE = re.compile(r"\d{1,2}[./-]\d{1,2}[./-](?:19|20)\d\d|(?:19|20)\d\d[./-]\d{1,2}[./-]\d{1,2}")
PHONE = re.compile(
    r"(?<![\w.,/-])(?:"
    r"\+\d{1,3}(?:[ ./-]{0,2}(?:\(\d{1,4}\)|\d)){6,13}(?!\w)"
    r"|00[1-9]\d?[ ./-]{1,2}(?:\(?\d\)?[ ./-]{0,2}){6,12}(?!\w)"
    r"|\(0?\d{2,5}\)[ ./-]{0,2}\d(?:[ ./-]{0,2}\d){4,9}(?!\w)"
    r"|0\d{1,4}(?:[ ./-]{1,2}\d{1,8}){1,5}(?!\w)"
    r"|0\d{9,10}(?!\w)"
    r"|[2-9]\d{2}([ .-])\d{3}\1\d{4}(?!\w)"
    r"|[6-9]\d{2} {1,2}\d{2,3}(?: {1,2}\d{2,3}){1,2}(?!\w)"
    r")(?![-/.,]?\d)"
)
PHONE_WORD = re.compile(
    r"(?<!\w)(?:tel|phone|telephone|téléphone|telefon|teléfono|mobile|móvil|handy|portable|call|ring|text|anrufen|fax|whatsapp|sms)\w{0,3}[.:\s]{0,3}(?P<v>\d(?:[ ./-]?\d){6,13})(?!\w)",
    re.I,
)


def _phones(text: str) -> list[tuple[int, int]]:
    out = []
    for m in PHONE.finditer(text):
        v, digits = m.group().rstrip(" ./-"), sum(c.isdigit() for c in m.group())
        least, most = (8, 15) if v[0] == "+" or v.startswith("00") else (9, 12)
        if v[0] in "6789" and "." not in v and "-" not in v and not re.match(r"\d{3} {1,2}\d{3} {1,2}\d{4}$", v):
            most = 10
        if least <= digits <= most and not _DATE.match(v):
            out.append((m.start(), m.start() + len(v)))
    out.extend(m.span("v") for m in PHONE_WORD.finditer(text) if not _DATE.match(m.group("v")))
    return out


# --- addresses -----------------------------------------------------------------------------------

_CAP = r"[A-ZÀ-ÖØ-ÞŁŽŠŚĆČĐŻŹİŐŰ]"
_TAIL = r"(?:,?\s+(?:Apt|Apartment|Flat|Unit|Suite|appt|bât|Hinterhaus|Vorderhaus|bajo)\.?(?:\s*\d+\w?)?)?(?:,\s+\d{4,5}(?!\d))?"
ADDRESS = [
    # house number first, kind of street last
    re.compile(
        rf"(?<![\w.,:/-])(?:(?:Flat|Unit|Apt\.?|Suite|#)\s*\d+\w?,\s+)?\d{{1,4}}[A-Za-z]?,?\s+(?:{_CAP}[\w'’.-]*\s+){{1,4}}?"
        rf"(?:Street|St|Road|Rd|Lane|Ln|Avenue|Ave|Drive|Dr|Close|Court|Ct|Way|Terrace|Place|Pl|Boulevard|Blvd|Square|Sq|Crescent|Row|Grove|Mews|Walk|Alley|Parade|Highway|Hwy|Parkway|Pkwy|Quay)(?!\w)\.?{_TAIL}"
    ),
    # French: house number, kind of street, its name
    re.compile(
        rf"(?<![\w.,:/-])\d{{1,4}}(?:\s?(?:bis|ter|quater|[A-Z]))?,?\s+(?:rue|r\.|avenue|av\.?|bd|bld|boulevard|chemin|ch\.|impasse|imp\.|place|pl\.?|allée|all\.|quai|route|rte|cours|passage|square|sentier|ruelle|faubourg|cité|villa|montée|esplanade|venelle)\s+"
        rf"(?:(?:de la|de l['’]|du|des|de|d['’]|aux|au|à la)\s*)?(?:(?:Vieux|Vieille|Grand|Grande|Petit|Petite|Haut|Bas)\s+)?{_CAP}[\w'’-]+{_TAIL}",
        re.I,
    ),
    # German: street, house number
    re.compile(
        rf"(?<!\w)(?:{_CAP}[\w.'’-]*(?:straße|strasse|str\.|weg|gasse|allee|platz|ring|ufer|damm|steig|stieg|pfad|chaussee|hof|berg|wall|markt|graben|park|brücke|tor)"
        rf"|(?:{_CAP}[\w'’-]+\s+)?(?:Straße|Strasse|Str\.|Weg|Gasse|Allee|Platz|Ring|Ufer|Damm|Chaussee)"
        rf"|(?:An der|An den|Am|Im|In der|Auf der|Auf dem|Zum|Zur|Unter den|Hinter der|Bei der|Alte[rs]?|Neue[rs]?|Hohe[rs]?|Lange[rs]?|Kleine[rs]?|Große[rs]?)\s+{_CAP}[\w'’-]+)"
        rf"\s+\d{{1,3}}\s?[a-z]?(?:\s?[/-]\s?\d+)?(?![\w:]|[.,]\d|\s*(?:Uhr|km|Tage|Wochen|Minuten|Jahre|Stunden|Monate|Euro|%))(?!\.\s*(?:{_CAP}[a-zä]+\s+\d{{4}}|\d)){_TAIL}"
    ),
    # Spanish and Italian: kind of street, its name, house number
    re.compile(
        rf"(?<!\w)(?:C/|Cl\.|Calle|Avenida|Avda\.?|Av\.|Plaza|Pza\.?|Pl\.|Paseo|P\.º|Pº|Camino|Cam\.|Carrera|Carretera|Ctra\.?|Ronda|Travesía|Callejón|Glorieta|Cuesta|Rambla|Via|Viale|Piazza|Corso|Rua)\s*"
        rf"(?:(?:de la|del|de los|de las|de|el|la|los|las)\s+)?{_CAP}[\w'’-]+(?:\s+(?:de\s+)?{_CAP}[\w'’-]+){{0,3}},?\s+(?:n\.?\s?[º°o]\.?\s*|núm\.?\s*|nº\s*)?\d{{1,4}}(?!\d|[.,]\d){_TAIL}"
    ),
    # Dutch: street, house number
    re.compile(rf"(?<!\w){_CAP}[\w'’-]*(?:straat|laan|gracht|kade|plein|dijk|steeg)\s+\d{{1,4}}\s?[a-z]?(?![\w:]|[.,]\d)"),
]
#: What a text must have for each of ADDRESS to apply; None where only the pattern can tell.
ADDRESS_HINTS = [
    ("Street", "St", "Road", "Rd", "Lane", "Ln", "Aven", "Ave", "Drive", "Dr", "Close", "Court", "Ct", "Way", "Terr", "Place", "Pl", "Boul", "Blvd", "Squ", "Sq", "Cresc", "Row", "Grove", "Mews", "Walk", "Alley", "Parade", "High", "Hwy", "Park", "Pkwy", "Quay"),
    (" rue", " r.", " aven", " av", " bd", " bld", " boul", " chem", " ch.", " imp", " pla", " pl", " all", " quai", " rout", " rte", " cour", " pass", " squ", " sent", " ruel", " faub", " cité", " vill", " mont", " espl", " ven"),
    None,
    ("C/", "Cl.", "Call", "Aven", "Avda", "Av.", "Plaz", "Pza", "Pl.", "Pase", "P.º", "Pº", "Cam", "Carr", "Ctra", "Rond", "Trav", "Glor", "Cuest", "Ramb", "Via", "Piaz", "Cors", "Rua"),
    ("straat", "laan", "gracht", "kade", "plein", "dijk", "steeg"),
]
_HOUSE_NUMBER_AFTER = re.compile(r"[^\W\d_.]\.?\s+\d{1,3}\s?[a-z]?(?![\w:])")
_DIGIT = re.compile(r"\d")

# --- names ---------------------------------------------------------------------------------------

#: Titles that stand before a surname.
TITLES = r"Mrs|Mr|Ms|Miss|Mx|Dr|Prof|Professor|Sir|Frau|Herrn?|Mme|Mlle|Madame|Monsieur|Mademoiselle|Sra|Sr|Srta|Señora?|Señorita|Don|Doña|Dra|Pfarrer|Maître|Me|Hr|Fr|señora?|señorita|doña|madame|monsieur|mademoiselle|Doctora?|doctora?|Profesora?|profesora?|professeur|docteur"
_SURNAME = rf"{_CAP}[\w'’]*[^\W\d_](?:-{_CAP}[\w'’]*[^\W\d_])*"
_INITIALS = rf"(?:{_CAP}\.\s*(?:-?{_CAP}\.\s*)*)"
BY_TITLE = re.compile(rf"(?<![\w-])(?:{TITLES})(?:\.\s*|\s+)(?:(?:{TITLES})(?:\.\s*|\s+))*(?:{_INITIALS}|(?:{_CAP}[\w'’-]+\s+){{0,2}}?)?(?P<s>{_SURNAME})")
BY_INITIAL = re.compile(rf"(?<![\w.º°/-])(?P<i>{_INITIALS})(?P<s>{_CAP}[\w'’]+(?:-{_CAP}[\w'’]+)*)")
BY_INTRODUCTION = re.compile(
    rf"(?i:\bI am|\bI['’]m|\bmy name is|\bich bin|\bich heiße|\bje suis|\bje m['’]appelle|\bsoy|\bme llamo)\s+(?P<s>{_SURNAME}\s+(?:{_INITIALS})?{_SURNAME})"
)
_CAPITAL_WORD = re.compile(rf"(?<!\w){_CAP}[^\W\d_]+")
_INITIAL_HINT = re.compile(rf"{_CAP}\.")
_TITLE_HINTS = ("Mr", "Ms", "Miss", "Mx", "Dr", "Prof", "Sir", "Frau", "Herr", "Mme", "Mlle", "adame", "onsieur", "ademoiselle", "Sr", "eñor", "Don ", "oña", "Pfarrer", "Maître", "Hr", "octor", "rofes", "octeur")
_INTRODUCTION_HINTS = ("i am ", "i'm ", "i’m ", "my name is", "ich bin ", "ich heiße", "je suis ", "appelle ", "soy ", "me llamo")
_AFTER_GIVEN = re.compile(rf"\s+(?:{_INITIALS}|{_SURNAME}\s+(?={_SURNAME}))?(?P<s>{_SURNAME}|{_CAP}\.)|\s+(?P<t>(?:von|van|de|del|della|di|du|da|der|den|ter|zu|la|le)(?:\s+(?:der|den|la|las|los))?\s+{_SURNAME})")


#: Function words of four languages. Where ``people`` has one as a given name, it counts
#: amid a sentence only, as any word has a capital at its start.
FUNCTION_WORDS = frozenset(
    "the a an and my our your this that these in on at of for from to with by it we you he she they i not no what when where how "
    "der die das ein eine und mein meine unser im am in zu von für mit aus es wir ihr sie er ich nicht was wo wie "
    "le la les un une et mon ma mes notre nos de du des en au aux à dans pour avec ce cette il elle nous vous je "
    "el los las uno una y mi mis nuestro nuestra del con para por lo al su sus este esta él ella nosotros yo".split()
)


def _sentence_start(text: str, i: int) -> bool:
    return not text[:i].strip() or text[:i].rstrip()[-1] in ".!?:"


def _names(text: str, given: frozenset[str]) -> list[tuple[int, int]]:
    out = []
    for m in _CAPITAL_WORD.finditer(text):
        w = m.group()
        if w.casefold() in given and not (w.casefold() in FUNCTION_WORDS and _sentence_start(text, m.start())):
            n = _AFTER_GIVEN.match(text, m.end())
            if n:
                s = n.group("s") or n.group("t")
                if len(s) > 2 or s.endswith("."):
                    out.append((m.start(), n.end()))
            elif m.start() and (b := re.search(rf"({_SURNAME}),\s+$", text[: m.start()])) and _sentence_start(text, b.start()) and text[m.end() : m.end() + 1] in ("", ".", ",", ";", ")"):
                out.append((b.start(), m.end()))
    for m in BY_TITLE.finditer(text) if any(h in text for h in _TITLE_HINTS) else ():
        if len(m.group("s")) >= 3 and not (m.group().startswith(("Me ", "Don ", "Fr ")) and m.group("s").casefold() in given):
            if not m.group().startswith(("Me ", "Fr ")):
                out.append(m.span())
    for m in BY_INITIAL.finditer(text) if _INITIAL_HINT.search(text) else ():
        before = text[: m.start()]
        # not after a number ("85 C. Then"), and not what ends a sentence with a lone letter
        if len(m.group("s")) >= 3 and not re.search(r"[\dº°]\s*$", before):
            out.append(m.span())
    low = text.lower()
    for m in BY_INTRODUCTION.finditer(text) if any(h in low for h in _INTRODUCTION_HINTS) else ():
        s = m.group("s")
        if s[0].isupper():
            out.append(m.span("s"))
    return out


def find_in_line(line: str, given: frozenset[str]) -> list[tuple[int, int, str]]:
    """(start, end, kind) of one line in its own characters, in order and without overlaps.

    Where finds overlap the earlier kind of email, id_number, address, phone, name stays.
    """
    if len(line) < 4:
        return []
    r = rewrite(line)
    text = r.text
    found: list[tuple[int, int, str]] = []
    taken: list[tuple[int, int]] = []

    def add(spans: Iterable[tuple[int, int]], kind: str) -> None:
        for s, e in spans:
            if all(e <= a or s >= b for a, b in taken):
                taken.append((s, e))
                found.append((s, e, kind))

    if "@" in text:
        add((m.span() for m in EMAIL.finditer(text)), "email")
    digits = len(_DIGIT.findall(text))
    if digits:
        if digits > 3:
            add((m.span("v") for m in ID_BY_WORD.finditer(text) if sum(c.isdigit() for c in m.group("v")) >= 4), "id_number")
            add((m.span() for m in ID_BY_SHAPE.finditer(text)), "id_number")
        low = text.lower()
        for k, (p, hints) in enumerate(zip(ADDRESS, ADDRESS_HINTS)):
            if not (_HOUSE_NUMBER_AFTER.search(text) if hints is None else any(h in (low if k == 1 else text) for h in hints)):
                continue
            add((m.span() for m in p.finditer(text)), "address")
        if digits > 6:
            add(_phones(text), "phone")
    add(_names(text, given), "name")
    return sorted((*r.span(s, e), k) for s, e, k in found)


def find_spans(text: str | None, given: frozenset[str]) -> list[tuple[int, int, int, str]]:
    """(line, start, end, kind); positions count code points from the start of the text. Lines end at
    a newline; lines that occur again are looked at once."""
    out: list[tuple[int, int, int, str]] = []
    if not text:
        return out
    seen: dict[str, list[tuple[int, int, str]]] = {}
    pos = 0
    for no, line in enumerate(text.split("\n")):
        if line not in seen:
            seen[line] = find_in_line(line, given)
        out.extend((no, pos + s, pos + e, k) for s, e, k in seen[line])
        pos += len(line) + 1
    return out


def redact_text(text: str | None, given: frozenset[str]) -> str | None:
    """The text with ``[EMAIL]``, ``[PHONE]`` and so on in place of what was found; all else unchanged."""
    if not text:
        return text
    out, pos = [], 0
    for _, s, e, kind in find_spans(text, given):
        out += [text[pos:s], f"[{kind.upper()}]"]
        pos = e
    return "".join(out) + text[pos:]


#: Given names that are sent along with the code; of more, each text meets those it has by a join.
MOST_GIVEN = 100_000
@arrow_function("string")
def _folded(words: pd.Series) -> pd.Series:
    return words.map(lambda w: unicodedata.normalize("NFC", w).casefold(), na_action="ignore")


def given_names(people: DataFrame, column: str = "name") -> DataFrame:
    """(first): every given name to look for, once: the first words, casefolded, of the names of ``people``."""
    first = F.regexp_extract(column, r"(?U)^[\s\x{1c}-\x{1f}]*([\p{L}\p{M}'’-]{2,})\s+\S", 1)
    raw = people.select(first.alias("first")).where(F.length("first") > 1).distinct()
    return raw.select(_folded("first").alias("first")).distinct()


def name_candidates(text: str | None) -> list[str]:
    """The words of a text that ``find_in_line`` looks up among given names, casefolded, each once."""
    out: set[str] = set()
    for line in set((text or "").split("\n")):
        if len(line) >= 4:
            t = rewrite(line).text
            out.update(w.casefold() for w in _CAPITAL_WORD.findall(t))
            out.update(m.group("s").casefold() for m in BY_TITLE.finditer(t))
    return sorted(out)


@arrow_function("array<string>")
def _candidates(texts: pd.Series) -> pd.Series:
    return pd.Series([name_candidates(t) for t in texts], dtype=object)


def with_given(rows: DataFrame, column: str, names: DataFrame, most: int = MOST_GIVEN) -> tuple[DataFrame, frozenset[str] | Column]:
    """``rows``, and the given names for their text ``column``: a set of them all if there are at most
    ``most``; otherwise rows have gained an array ``given`` of those that the text itself may have."""
    few = names.limit(most + 1).collect()
    if len(few) <= most:
        return rows, frozenset(r["first"] for r in few)
    key = F.sha2(column, 256)
    words = rows.select(column).where(F.length(column) > 0).distinct().select(key.alias("text_key"), F.explode(_candidates(column)).alias("first"))
    has = words.join(names, "first").groupBy("text_key").agg(F.collect_set("first").alias("given"))
    return rows.withColumn("text_key", key).join(has, "text_key", "left").drop("text_key"), F.col("given")


SPAN = "array<struct<line:int,start:int,finish:int,kind:string>>"


def _sets(given: pd.Series) -> list[frozenset[str]]:
    return [frozenset() if g is None else frozenset(g) for g in given]


def spans_of(column: Column, given: frozenset[str] | Column) -> Column:
    """Every find in a text column, with its line and code point positions. Null gives an empty list."""

    def finds(t, names):
        return [{"line": n, "start": s, "finish": e, "kind": k} for n, s, e, k in find_spans(t, names)]

    @arrow_function(SPAN)
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([finds(t, given) for t in texts], dtype=object)

    @arrow_function(SPAN)
    def run_each(texts: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([finds(t, g) for t, g in zip(texts, _sets(names))], dtype=object)

    return run_each(column, given) if isinstance(given, Column) else run(column)


def redacted(column: Column, given: frozenset[str] | Column) -> Column:
    """The text column with typed placeholders. Null stays null, empty stays empty."""

    @arrow_function("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redact_text(t, given))

    @arrow_function("string")
    def run_each(texts: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([redact_text(t, g) for t, g in zip(texts, _sets(names))], dtype=object)

    return run_each(column, given) if isinstance(given, Column) else run(column)


def quotes_of(column: Column) -> Column:
    """The ``quotes`` of an enrichment object as JSON; unreadable JSON, or none, gives an empty list.
    Elements that are no strings are null, so that the positions of the others hold."""

    @arrow_function("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            quotes = None
            if t:
                try:
                    o = json.loads(t)
                    quotes = o.get("quotes") if isinstance(o, dict) else None
                except (ValueError, RecursionError):
                    pass
            out.append([q if isinstance(q, str) else None for q in quotes] if isinstance(quotes, list) else [])
        return pd.Series(out, dtype=object)

    return run(column)


def personal_information(versions: DataFrame, extractions: DataFrame, people: DataFrame, most: int = MOST_GIVEN) -> DataFrame:
    """(field, version_id, prompt_version, pos, kind): one row per kind present in a line of
    ``text_md`` (pos = line number) or in a quote (pos = index). Exact duplicates count once; null and
    empty texts, and JSON that cannot be read, have no rows. Texts are looked at whole, each once.
    """
    names = durable(given_names(people))
    texts, given = with_given(versions.select("version_id", "text_md").where(F.length("text_md") > 0).distinct(), "text_md", names, most)
    text = texts.select("version_id", F.explode(spans_of(F.col("text_md"), given)).alias("s")).select(
        F.lit("text_md").alias("field"), "version_id", F.lit("").alias("prompt_version"), F.col("s.line").alias("pos"), F.col("s.kind").alias("kind")
    )
    said = (
        extractions.select("version_id", "prompt_version", "json").where(F.length("json") > 0).distinct()
        .select("version_id", "prompt_version", F.posexplode(quotes_of(F.col("json"))).alias("pos", "quote"))
        .where(F.length("quote") > 0)
    )
    said, given = with_given(said, "quote", names, most)
    quotes = (
        said.select("version_id", "prompt_version", "pos", F.explode(F.transform(spans_of(F.col("quote"), given), lambda s: s["kind"])).alias("kind"))
        .select(F.lit("quotes").alias("field"), "version_id", "prompt_version", "pos", "kind")
    )
    return text.unionByName(quotes).distinct()
