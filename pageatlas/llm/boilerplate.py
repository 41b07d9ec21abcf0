"""Page text without the furniture of the site, by consensus host paths.

A page's lines stand in containers (runs of lines between blank ones). What a line says for itself is
a score: word lists of four languages and its shape give a first guess, a text that is no sentence
and recurs on several hosts, or that stands on most pages of its host, counts as furniture whatever
the guess. A container is scored by its lines. Each line then gets a generalised tag-class path that
knows nothing of words: the zone of the page, its mark-up, its links and shape, and how its container
without it scores. Paths are voted on per host, with all hosts as a prior, and the pages are
extracted again with the paths that won: the odds of a line's path on its host and those of its own
score are multiplied, so that a clear vote overrides a wrong score, of either kind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageatlas.functions.arrow import arrow_function
from pageatlas.session import durable

#: The vote of all hosts on a path counts as much as so many lines of one host.
PRIOR_LINES = 8.0
#: A text without sentence or heading that stands on such a share of all hosts, and on so many, is furniture with
#: so much certainty; bounds of a line's own score and of a vote, as neither is ever certain.
RECUR_SHARE, RECUR_HOSTS, RECUR_SCORE, OWN_BOUNDS, VOTE_BOUNDS = 0.003, 3, 0.8, 0.05, 0.01
#: On how many distinct pages of a host, and on what share of them, a text is repeated furniture. Headings
#: of sections are the author's own, so that they need to stand on nearly every page.
REPEAT_PAGES, REPEAT_SHARE, REPEAT_SHARE_HEADING = 3, 0.5, 0.9


def _words(text: str) -> frozenset[str]:
    return frozenset(w.strip() for w in text.split(","))


#: Menu entries of four languages.
MENU = _words(
    "home,about,about me,now,blog,archive,archives,photos,photo,contact,uses,notes,projects,guestbook,elsewhere,links,writing,work,now page,"
    "startseite,über mich,über,jetzt,notizen,fotos,kontakt,projekte,archiv,gästebuch,werkzeug,"
    "accueil,à propos,maintenant,carnet,projets,livre d'or,liens,outils,"
    "inicio,sobre mí,sobre,ahora,notas,contacto,proyectos,archivo,libro de visitas,enlaces,herramientas,en otros sitios"
)
#: Buttons of consent notices and controls of four languages.
BUTTONS = _words(
    "ok,okay,got it,got it!,accept,accept all,accept cookies,only necessary,necessary only,reject all,decline,manage preferences,preferences,settings,cookie settings,i agree,close,"
    "alle akzeptieren,akzeptieren,nur notwendige,nur notwendige cookies,ablehnen,einstellungen,einstellungen verwalten,einverstanden,verstanden,schließen,"
    "tout accepter,accepter,tout refuser,refuser,j'ai compris,paramétrer,gérer mes choix,personnaliser,seulement le nécessaire,fermer,"
    "aceptar todo,aceptar,rechazar,rechazar todo,entendido,configurar,solo necesarias,cerrar,ajustes,"
    "skip to main content,skip to content,toggle navigation,menu,menü,menú,search this site,search,suche,suchen,rechercher,recherche,buscar,log in,login,sign up,sign in,register,"
    "anmelden,registrieren,connexion,se connecter,s'inscrire,inscription,iniciar sesión,entrar,registrarse,zum inhalt springen,aller au contenu,saltar al contenido,"
    "back to top,nach oben,haut de page,volver arriba,print,drucken,imprimer,imprimir,advertisement,anzeige,publicité,publicidad,werbung,anuncio,newsletter"
)
#: Heads of lists of other posts, archives and the like.
LIST_HEADS = _words(
    "recent posts,popular posts,latest posts,related posts,you may also like,more posts,archive,archives,elsewhere,blogroll,links,tags,categories,tag cloud,on this site,read next,see also,"
    "neueste beiträge,beliebte beiträge,letzte beiträge,ähnliche beiträge,auch interessant,archiv,schlagwörter,kategorien,anderswo,mehr lesen,"
    "articles récents,articles populaires,derniers articles,à lire aussi,archives,étiquettes,catégories,mots-clés,ailleurs,"
    "entradas recientes,entradas populares,últimas entradas,también te puede gustar,te puede interesar,archivo,archivos,etiquetas,categorías,en otros sitios,otros sitios"
)
_MONTHS = (
    "january|february|march|april|may|june|july|august|september|october|november|december|januar|februar|märz|mai|juni|juli|oktober|dezember|"
    "janvier|février|mars|avril|juin|juillet|août|septembre|octobre|novembre|décembre|enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|octubre|noviembre|diciembre"
)
_DATE = rf"(?:\d{{1,4}}[./-]\d{{1,2}}[./-]\d{{1,4}}|(?:\d{{1,2}}\.?\s+(?:de\s+)?)?(?:{_MONTHS})\.?\s+(?:de\s+)?(?:\d{{1,2}},?\s+)?\d{{4}})"

#: What whole lines of furniture say, by class, in four languages. Tried in order on the
#: line without mark-up.
LINE_CLASSES = [
    (name, re.compile(pattern, re.I))
    for name, pattern in [
        ("archive", rf"(?:{_MONTHS})\s+(?:de\s+)?(?:19|20)\d\d(?:\s*\(\d+\))?$|(?:19|20)\d\d\s*\(\d+\)$"),
        ("counter", r"[\d.,\s'’]+\s*(?:visitors?|views?|hits|visits|besucher|aufrufe|besuche|vues|visites|visiteurs|visitas|lecturas|visitantes)(?:\s+(?:since|seit|depuis|desde)\s+\d{4})?\W*$|you are visitor|sie sind (?:der )?besucher|vous êtes le (?:\S+ )?visiteur|eres (?:el )?(?:la )?visit|besucher(?:zähler| nr)|visiteurs?\s*:|visitors?\s*:|hits\s*:"),
        ("stamp", rf"_?\W*(?:this page was\s+)?(?:last\s+)?(?:updated|modified|edited|changed)\s*(?:on|:|-)?\s*\W*{_DATE}\W*$|(?:zuletzt (?:aktualisiert|geändert|bearbeitet)(?: am)?|stand|letzte (?:änderung|aktualisierung)|mis(?:e)? à jour(?: le)?|dernière (?:mise à jour|modification)|modifié le|última (?:actualización|modificación)|actualizado(?: el)?|modificado el)\s*:?\s*{_DATE}\W*$"),
        ("consent", r"(?:this|our) (?:web)?site uses? cookies|we use cookies|by continuing to browse|your privacy matters|we and our \d+ partners|we value your privacy|diese (?:web)?seite verwendet cookies|diese website (?:verwendet|nutzt) cookies|mit der nutzung dieser|wir und (?:unsere )?\d+ partner|ihre privatsphäre|wir verwenden cookies|ce site utilise des cookies|en poursuivant votre navigation|nous et nos \d+ partenaires|votre vie privée|nous utilisons des cookies|este sitio (?:web )?(?:usa|utiliza) cookies|si continúas navegando|nosotros y \d+ socios|nosotros y nuestros|tu privacidad|utilizamos cookies"),
        ("share", r"(?:share (?:this|on|via)|teilen|partager|compartir|follow (?:on|me)|folgen|suivre|seguir|auf folgen)\b[^.!?]*$|\[?(?:tweet|toot|share|teilen|partager|compartir)\]|like this\? buy me|buy me a coffee|.*\b(?:kaffee spendieren|offrez-moi un café|invítame a un café)"),
        ("subscribe", r"subscribe\b|get one letter|join [\d.,]+ other readers|enter your e-?mail|.*\bnewsletter\b.*\b(?:abonnieren|verpassen)|.*feed abonnieren|abonnez-vous|suscríbete|jetzt [\d.,]+ anderen lesern|rejoignez\b.*(?:lecteurs|lectrices|abonn)|únete\b.*(?:lectores|personas)|recevez|recibe una carta|ein brief (?:im|pro) monat|e-?mail-adresse eingeben|votre adresse e-?mail|tu (?:dirección de )?correo|s'abonner|abonnieren|.*no spam, unsubscribe"),
        ("advert", r"sponsored|advertisement|anzeige\b|werbung\b|publicité|publicidad|patrocinad|gesponsert|sponsorisé|contenu sponsorisé|unterstützt von|presented by"),
        ("comments", r"\d+\s+(?:comments?|kommentare?|commentaires?|comentarios?)\b|leave a (?:reply|comment)|kommentar (?:hinterlassen|schreiben)|laisser un commentaire|deja (?:un|tu) comentario|antworten$|répondre$|responder$|no comments"),
        ("filing", r"(?:filed under|posted in|tagged|tags|categories|abgelegt unter|kategorien?|schlagwörter|veröffentlicht in|classé (?:dans|sous)|catégories?|étiquettes?|publié dans|archivado en|categorías?|etiquetas?|publicado en)\s*:"),
        ("legal", r"©|\(c\) ?\d{4}|copyright\b|all rights reserved|alle rechte vorbehalten|tous droits réservés|todos los derechos reservados|privacy policy|imprint\b|impressum\b|datenschutz|mentions légales|aviso legal|opinions here are my own|views (?:here|expressed) are my own|unless noted otherwise|inhalte dieser seite|sauf mention contraire|salvo indicación contraria|licensed under|cc[ -]by|die hier geäußerten|les opinions (?:exprimées )?ici|las opiniones (?:expresadas )?aquí|terms (?:of|and|&)|agb\b|confidentialité|privacidad"),
        ("technical", r"powered by|läuft mit|propulsé par|funciona con|hecho con|fait avec|made with|(?:theme|thème|tema|thema|design|diseño|conception|gestaltung|layout|template)\s*:|site design by|design by|v\d+(?:\.\d+)+\b|built (?:by hand )?with .*\bhosted\b|built with|view source|report a problem|.*rendered in \d|site ?map|plan du site|mapa del sitio|seitenübersicht|dark mode|listen to this page|reading time|lesezeit|temps de lecture|tiempo de lectura|mode sombre|modo oscuro|dunkler modus|quelltext|fehler melden|anhören|écouter|escuchar"),
        ("webring", r".*\bweb-?ring\b|.*[←«<].*(?:ring|anneau|anillo).*[→»>]|\S+(?: \S+)? is a member of the .*(?:sites|ring)|.*\bmember of the\b.*\bsmall sites|.*\bmitglied (?:im|der|des)\b.*(?:seiten|ring|bund)|.*\bmembre (?:de l[’']|du)\b.*(?:sites|anneau|alliance)|.*\bmiembro de(?: la|l)\b.*(?:sitios|anillo|alianza)"),
        ("feed", r"(?:rss|atom|json feed|flux rss|feed|fediverse|mastodon)\b(?:\s*[|·/,]\s*\S+)*\W*$|subscribe via|suivre le flux|sigue el feed"),
        ("contact", r"(?:✉|📧|☎|📞)|(?:contact|mail|e-?mail|kontakt|contacto|correo|courriel)\s*[.:]+\s*(?:\S+(?:\s*[\[({<]?\s*(?:at|@|arroba|dot|punto|point|punkt)\s*[\])}>]?\s*\S+)*|[+\d][\d\s()./-]+)$"),
        ("language", r"(?:\[?(?:en|de|fr|es|it|nl|pt|english|deutsch|français|español|italiano)\]?\s*[|·/,\s]\s*)+\[?(?:en|de|fr|es|it|nl|pt|english|deutsch|français|español|italiano)\]?$"),
    ]
]
#: How titles of other posts begin in four languages.
POST_TITLE = re.compile(
    r"(?:on \S.* and \S+|why i stopped|a year of|three lessons from|notes on|vom versuch,|ein jahr, um|notizen\s*:|drei lektionen|warum ich|un an pour|pourquoi |notes\s*:|trois leçons|por qué |un año para|apuntes\s*:|tres lecciones)(?!.*[.!?]$)",
    re.I,
)
#: Words that names of sites do not consist of, though titles of sections may.
_SECTION_WORDS = _words("zu,am,im,in,mein,meine,der,die,das,wo,was,my,the,at,on,what,where,this,la,el,en,à,le,les,ce,que,lo,mi,now,jetzt,ahora,maintenant,hause")
_SITE_NAME = re.compile(r"[A-ZÀ-ÖØ-ÞŁŽŠ][\w'’]+(?: [A-ZÀ-ÖØ-ÞŁŽŠ][\w'’]+){1,2}(?:\s+[–—|-]\s+\S.*)?$")
_OWN_LINK = re.compile(r"\]\((?:https?:)?//", re.I)
_SPEAKS = re.compile(r"[?:] \S|^t[eé]l\b", re.I)
_MARK = re.compile(r"^\s*(?:(#{1,6})\s+|([-*+•])\s+|(\d{1,3}[.)])\s+|(>)\s*)?(.*?)\s*$", re.S)
_LINK = re.compile(r"!?\[([^\]]*)\]\(([^)]*)\)")
_SEPARATOR = re.compile(r"\s*[|·/»•]\s+|\s+[|·/»•]\s*|\s{2,}|\)\s*\[")
_SENTENCE_END = re.compile(r"[.!?…:;](?:[\"'”’)*_\]]*)(?:\s*\([^)]*\))?[.!?]?$|[☀-➿\U0001f300-\U0001faff]$")


def line_class(text: str) -> str:
    """The class of a line's text without mark-up: ``menu``, ``button``, one of LINE_CLASSES, or none."""
    plain = text.strip(" *_`\t\r").strip()
    low = plain.casefold().strip("☰↑↓←→▶✕×! ").strip()
    if low in MENU:
        return "menu"
    if low in BUTTONS:
        return "button"
    for name, p in LINE_CLASSES:
        if p.match(plain):
            return name
    parts = [p.strip(" *_[]()").casefold() for p in _SEPARATOR.split(plain) if p.strip(" *_[]()")]
    if len(parts) > 1:
        known = sum(p in MENU or p in BUTTONS for p in parts)
        if known * 2 >= len(parts):
            return "menu"
        if all(any(c.match(p) for _, c in LINE_CLASSES) or p in MENU for p in parts):
            return "footer"
    return ""


class Line:
    """One non-blank line: its number, mark-up, text without it, class and shape. Without ``lists`` no word
    of any language is known, and lines have no class."""

    __slots__ = ("no", "tag", "text", "cls", "words", "ends", "linked", "bold", "block", "lists", "outward", "head", "sentence", "prose", "shape", "said", "general")

    def __init__(self, no: int, raw: str, block: int, lists: bool = True):
        self.lists = lists
        h, bullet, number, quote, text = _MARK.match(raw).groups()
        self.no, self.block = no, block
        self.bold = len(text) > 4 and text.startswith("**") and text.endswith("**")
        links = _LINK.findall(text)
        plain = _LINK.sub(lambda m: m.group(1), text)
        self.linked = bool(links) and "](mailto:" not in text and sum(len(a) for a, _ in links) > 0.6 * len(re.sub(r"[\s|·/»•]", "", plain) or " ")
        plain = plain.strip("*_ ") if self.bold or text[:1] == "_" == text[-1:] else plain
        self.text = plain
        self.tag = "h" if h else "li" if bullet else "ol" if number else "q" if quote else "b" if self.bold else "a" if self.linked else "p"
        self.cls = line_class(text if len(links) > 1 else plain) if lists else ""
        self.outward = self.linked and bool(_OWN_LINK.search(text))
        # whether it heads a list of other posts, archives or tags
        self.head = lists and self.tag in "hbp" and plain.casefold().strip(" :*") in LIST_HEADS
        self.words = len(plain.split())
        self.ends = bool(_SENTENCE_END.search(plain)) or bool(_SPEAKS.search(plain) and self.cls == "")
        if not self.cls:
            own = len(links) == 1 and bool(_OWN_LINK.search(text))
            if lists and POST_TITLE.match(plain) and self.tag != "h" and not own:
                self.cls, self.ends = "post", False
            elif self.tag in "phb" and _SITE_NAME.match(plain) and not _SECTION_WORDS & set(plain.casefold().split()):
                self.cls = "site"
            elif own or (self.bold and not self.head) or (self.tag in ("li", "ol") and plain[:1].islower()):
                self.cls = "own"

        self.sentence = self.ends and self.words >= 5
        self.prose = self._is_prose()
        # what a path tells of a line beside its zone: mark-up, links, and length
        link = "outward" if self.outward else "linked" if self.linked else "parted" if _SEPARATOR.search(plain) else "plain"
        self.shape = f"{self.tag}/{link}/{'sentence' if self.sentence else 'long' if self.words >= 12 else 'one' if self.words < 3 else 'short'}"
        self.said = _key(raw.strip())
        self.general = None if self.sentence or self.tag == "h" else _key(_general(plain))

    def _is_prose(self) -> bool:
        """Whether it reads as the author's: a sentence, or a heading that names no furniture."""
        if self.cls == "own":
            return True
        if self.cls or self.head or self.linked:
            return False
        if not self.lists:
            return self.sentence
        return self.tag == "h" or (self.ends and self.words >= 3) or self.words >= 12

    def at(self, no: int, block: int) -> Line:
        """The same line in another place."""
        x = Line.__new__(Line)
        for name in Line.__slots__:
            setattr(x, name, getattr(self, name))
        x.no, x.block = no, block
        return x


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


_DIGITS, _WORDS = re.compile(r"\d+"), re.compile(r"[^\W_]+")


def _general(text: str) -> str:
    """A line's words without mark-up, numbers and marks."""
    return " ".join(_WORDS.findall(_DIGITS.sub("0", text).casefold()))


#: Lines kept to be read once where they occur again; one task's, and no more than these.
KNOWN_LINES = 50_000


def read_lines(text: str, lists: bool = True, known: dict[str, Line] | None = None) -> list[Line]:
    known = {} if known is None else known
    out, block, blank = [], 0, True
    for no, raw in enumerate(text.split("\n")):
        if not raw.strip():
            blank = True
            continue
        if blank:
            block, blank = block + 1, False
        x = known.get(raw)
        if x is None:
            x = Line(no, raw, block, lists)
            if len(known) < KNOWN_LINES:
                known[raw] = x
            out.append(x)
        else:
            out.append(x.at(no, block))
    return out


def line_scores(text: str | None, lists: bool = True, known: dict[str, Line] | None = None) -> Iterator[tuple[Line, str, float]]:
    """(line, zone, furniture score) of each non-blank line.

    zone: ``top`` before the page's first prose, ``end`` after its last, else ``mid``. Scores: 1 for what
    a class names, lower for lines listed under a head of other posts or archives and for what only
    place and shape suggest, 0 for prose.
    """
    if not text:
        return
    lines = read_lines(text, lists, known)
    prose = [i for i, x in enumerate(lines) if x.prose]
    first, last = (prose[0], prose[-1]) if prose else (len(lines), -1)
    under, under_block = "", -1
    for i, x in enumerate(lines):
        zone = "top" if i < first else "end" if i > last else "mid"
        menu_around = any(y.cls == "menu" and y.block == x.block for y in lines[max(0, i - 1) : i] + lines[i + 1 : i + 2])
        is_head = x.head and not (x.tag == "p" and menu_around)
        if is_head:
            under, under_block = "list", x.block
        elif under and (x.tag == "h" or (x.ends and not x.linked and x.words > 5) or (x.block > under_block + 1 and not x.linked)):
            under = ""
        elif under and x.block != under_block and x.tag == "p" and not x.linked and not x.cls:
            under = ""
        if is_head:
            score = 1.0
        elif x.cls == "own":
            score = 0.0
        elif x.cls == "site":
            score = 1.0 if zone == "top" or i == 0 else 0.3
        elif x.cls == "menu" and x.tag == "h":
            score = 0.0
        elif x.cls:  # a class that a sentence may happen to begin with is less sure amid prose
            score = 0.9 if x.cls == "button" and x.tag == "h" and zone != "end" else 1.0
        elif under:
            score = 0.9
        elif x.tag == "h":
            score = 0.0
        elif x.linked:
            score = 0.8 if zone != "mid" or x.tag == "li" else 0.6
        elif x.words < 12 and not x.ends:
            score = 0.9 if zone != "mid" else 0.2
        else:
            score = 0.0
        yield x, zone, score


_LINES = "array<struct<line_no:int,block:int,path:string,score:float,said:bigint,general:bigint,heading:boolean>>"


def lines_of(text: Column, lists: bool = True) -> Column:
    """Of every non-blank line of a page its container, path and score, and keys of its text: as it is
    without blanks at its ends, and, unless it is a sentence or a heading, in general form."""

    @arrow_function(_LINES)
    def run(texts: pd.Series) -> pd.Series:
        out, known = [], {}
        for t in texts:
            out.append(
                [
                    {"line_no": x.no, "block": x.block, "path": f"{zone}/{x.shape}", "score": score, "said": x.said, "general": x.general, "heading": x.tag == "h"}
                    for x, zone, score in line_scores(t, lists, known)
                ]
            )
        return pd.Series(out, dtype=object)

    return run(text)


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]+)", 1))
    return F.regexp_replace(host, r"^www\.", "")


def page_of(url: Column) -> Column:
    """A key of the page a url names: without scheme, ``www.``, fragment and slash at the end."""
    return F.xxhash64(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:www\.)?|/?(?:#.*)?$", ""))


def repeated_texts(lines: DataFrame) -> DataFrame:
    """(host, said): texts that stand on most distinct pages of their host. Several versions of one
    page count once, and so do several urls with one text."""
    distinct = F.least(F.count_distinct("page"), F.count_distinct("doc"))
    hosts = lines.where("host <> ''").select("host", "page", "doc").distinct().groupBy("host").agg(distinct.alias("pages")).where(F.col("pages") >= REPEAT_PAGES)
    share = F.when(F.col("heading"), REPEAT_SHARE_HEADING).otherwise(REPEAT_SHARE)
    return (
        lines.join(hosts, "host")
        .groupBy("host", "said")
        .agg(distinct.alias("on"), F.max("pages").alias("pages"), F.max("heading").alias("heading"))
        .where((F.col("on") >= REPEAT_PAGES) & (F.col("on") >= share * F.col("pages")))
        .select("host", "said")
    )


def recurring_texts(lines: DataFrame) -> DataFrame:
    """(general): general forms that stand on RECUR_SHARE of the hosts, RECUR_HOSTS at least."""
    hosts = lines.where("host <> ''").agg((F.approx_count_distinct("host", 0.01) * RECUR_SHARE).alias("least"))
    on = lines.where("general is not null and host <> ''").select("general", "host").distinct().groupBy("general").agg(F.count("*").alias("on"))
    return on.crossJoin(F.broadcast(hosts)).where((F.col("on") >= RECUR_HOSTS) & (F.col("on") >= F.col("least"))).select("general")  # one row


def furniture_lines(versions: DataFrame, lists: bool = True, vote: bool = True) -> DataFrame:
    """(version_id, line_no) of each line that is not the author's own content.

    Paths form a small fixed grammar, so the votes over all hosts are a table of bounded size; per
    host they are aggregated map-side first, so a host with a third of all pages is a few hundred rows
    a task. Exact duplicates count once. Null and blank texts have no lines; a text without prose is
    furniture but for its headings. ``lists`` and ``vote`` leave out the word lists and the vote on
    paths, to show what each does.
    """
    pages = versions.select("version_id", "url", "text_md").where(F.length("text_md") > 0).distinct()
    lines = durable(
        pages.select("version_id", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"), page_of(F.col("url")).alias("page"), F.xxhash64("text_md").alias("doc"), F.explode(lines_of(F.col("text_md"), lists)).alias("l"))
        .select("version_id", "host", "page", "doc", "l.*")
    )
    repeated = repeated_texts(lines).withColumn("repeats", F.lit(True))
    recurring = recurring_texts(lines).withColumn("recurs", F.lit(True))
    marked = lines.join(repeated, ["host", "said"], "left").join(recurring, "general", "left")
    own = F.when(F.col("repeats"), 1.0).when(F.col("recurs"), F.greatest(F.col("score").cast("double"), F.lit(RECUR_SCORE))).otherwise(F.col("score").cast("double"))
    marked = marked.select("version_id", "doc", "host", "line_no", "block", "path", own.alias("own"), F.coalesce("repeats", F.lit(False)).alias("repeats"))
    # how the container scores without the line; a lone line goes by its neighbours
    page = Window.partitionBy("version_id", "doc").orderBy("line_no")
    block = Window.partitionBy("version_id", "doc", "block")
    others = F.count("*").over(block) - 1
    around = (F.sum("own").over(block) - F.col("own")) / F.greatest(others, F.lit(1))
    beside = [F.lag("own").over(page), F.lead("own").over(page)]
    near = sum(F.coalesce(b, F.lit(0.0)) for b in beside) / F.greatest(F.lit(1), sum(b.isNotNull().cast("int") for b in beside))
    seen = marked.select("*", others.alias("others"), around.alias("around"), near.alias("near"))
    level = lambda c, hi, lo: F.when(c > hi, "2").when(c > lo, "1").otherwise("0")
    container = F.when(F.col("others") > 0, F.concat(F.lit("c"), level(F.col("around"), 0.66, 0.2))).otherwise(F.concat(F.lit("n"), level(F.col("near"), 0.6, 0.4)))
    scored = durable(seen.select("version_id", "host", "line_no", F.concat_ws("/", "path", container).alias("path"), "own", "repeats"))
    odds = lambda p, least: F.log(F.greatest(F.least(p, F.lit(1 - least)), F.lit(least)) / (1 - F.greatest(F.least(p, F.lit(1 - least)), F.lit(least))))
    if not vote:
        return scored.where("own >= 0.5").select("version_id", "line_no").distinct()
    by_host = durable(scored.groupBy("host", "path").agg(F.sum("own").alias("s"), F.count_if("repeats").alias("r"), F.count("*").cast("double").alias("n")))
    overall = by_host.groupBy("path").agg((F.sum("s") / F.sum("n")).alias("mean"))
    here = (F.col("s") + PRIOR_LINES * F.col("mean")) / (F.col("n") + PRIOR_LINES)
    # a path most of whose lines repeat over the host's pages takes all its lines there along
    repeats = F.col("r") / (F.col("n") + PRIOR_LINES) >= 0.5
    votes = by_host.join(overall, "path").select("host", "path", odds(here, VOTE_BOUNDS).alias("vote"), repeats.alias("frame"))
    won = F.col("repeats") | F.col("frame") | (odds(F.col("own"), OWN_BOUNDS) + F.col("vote") > 0)
    return scored.join(votes, ["host", "path"]).where(won).select("version_id", "line_no").distinct()


def main_text(versions: DataFrame) -> DataFrame:
    """(version_id, main_text): each page without its furniture, runs of blank lines closed up."""
    gone = furniture_lines(versions).groupBy("version_id").agg(F.collect_list("line_no").alias("gone"))
    pages = versions.select("version_id", "text_md").distinct().join(gone, "version_id", "left")
    kept = F.filter(F.split("text_md", "\n"), lambda line, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    body = F.regexp_replace(F.array_join(kept, "\n"), r"\n\s*\n(?:\s*\n)+", "\n\n")
    return pages.select("version_id", F.regexp_replace(body, r"^\s+|\s+$", "").alias("main_text"))
