"""The main body of web pages: layout-aware rendering, then a decision on each line.

A tree builder with implied end tags and visibility rules turns markup into visible text that keeps block
spacing, lists and table cells in columns, and knows the source line of each piece. The rendered lines are
then judged twice: by where they stand and how they are laid out (runs of short lines before the first
sentence, rows of short items, paths that end in the page's title, what follows the last sentence), and by
what they say (menus, buttons, consent notices, prompts, lists of other roles, legal footers). Nothing is
judged by how often it recurs.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scale import cut, guarded_join

# Kinds of elements.
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("head script style template noscript title iframe object svg math select datalist canvas audio video".split())
#: Elements of the site around the text, by their tag alone.
SITE = set("nav footer aside button".split())
#: A start tag on the left ends open elements on the right, up to an element that limits the search.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
PARAGRAPH_ENDERS = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "summary", "legend", "dialog"}
TAG = re.compile(r"<!--.*?(?:-->|$)|<(?:!|\?)[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\s+[^\s=>\"'/]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?|\s*/)*)\s*>", re.S)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Piece:
    """Visible text on one source line: its text, whether the site's own elements hold it, and how it begins."""

    __slots__ = ("block", "cell", "item", "line", "site", "text")

    def __init__(self, line: int, text: str, site: bool, block: bool, cell: int, item: bool = False) -> None:
        self.line, self.text, self.site, self.block, self.cell, self.item = line, text, site, block, cell, item


def pieces(source: str) -> list[Piece]:
    """Visible text of ``source`` in order, cut at source lines and blocks."""
    out: list[Piece] = []
    stack: list[tuple[str, bool, bool]] = []  # (tag, unseen, site)
    line, at, fresh, cell, item = 1, 0, True, -1, False

    def text(part: str) -> None:
        nonlocal line, fresh, item
        unseen, site = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        for i, row in enumerate(part.split("\n")):
            if i:
                line += 1
                fresh = True
            if not unseen and row.strip():
                out.append(Piece(line, htmllib.unescape(row), site, fresh, cell, item))
                fresh = item = False

    def close(names: set[str], stop: set[str]) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                del stack[k:]
                if any(s[0] in names for s in stack) and not stop:
                    continue
                return
            if stack[k][0] in stop:
                return

    if "<" not in source:
        text(source)
        return out
    for m in TAG.finditer(source):
        if m.start() < at:
            continue
        text(source[at : m.start()])
        at = m.end()
        line += m.group().count("\n")
        slash, tag, attributes = m.group(1), (m.group(2) or "").lower(), m.group(3) or ""
        if not tag:
            continue
        if tag in BLOCKS or tag == "br":
            fresh = True
            item = tag == "li" and not slash
        if slash:
            if tag == "tr":
                cell = -1
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in PARAGRAPH_ENDERS:
            close({"p"}, {"div", "section", "article", "li", "td", "th", "blockquote"} if tag != "p" else {"li", "td", "th", "blockquote"})
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag == "tr":
            cell = -1
        elif tag in ("td", "th"):
            cell += 1
        if tag in VOID or attributes.rstrip().endswith("/"):
            continue
        unseen, site = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        stack.append((tag, unseen or tag in UNSEEN or bool(HIDDEN.search(attributes)), site or tag in SITE))
        if tag in ("script", "style", "textarea", "title"):  # text up to the end tag isn't markup
            end = re.compile(rf"</{tag}", re.I).search(source, at)
            stop = end.start() if end else len(source)
            text(source[at:stop])
            at = stop
    text(source[at:])
    return out


def rendered(source: str, bullets: bool = False) -> str:
    """All visible text: one line per block, a blank one between source paragraphs, cells in columns; with ``bullets`` '- ' before list items."""
    rows: list[tuple[int, list[str]]] = []
    for p in pieces(source):
        piece = re.sub(r"\s+", " ", p.text).strip()
        if p.cell > 0 and rows:
            rows[-1][1].append(piece)
        elif p.block or not rows:
            rows.append((p.line, [f"- {piece}" if bullets and p.item and not BULLET.match(piece) else piece]))
        else:
            rows[-1][1][-1] += " " + piece
    widths: dict[int, int] = {}
    for _, cells in rows:
        if len(cells) > 1:
            for i, c in enumerate(cells):
                widths[i] = max(widths.get(i, 0), len(c))
    lines, last = [], 0
    for at, cells in rows:
        if last and at > last + 1:
            lines.append("")
        lines.append(" | ".join(c.ljust(widths[i]) for i, c in enumerate(cells)).rstrip() if len(cells) > 1 else cells[0])
        last = at
    return "\n".join(lines)


# Items of menus, by language.
MENU = set(
    "home|careers|career|jobs|search jobs|find jobs|all jobs|open positions|locations|teams|students|graduates|news|newsroom|press|blog|investors|investor relations|faq|faqs|help|support|"
    "contact|contact us|about|about us|our values|our culture|culture|my profile|profile|my account|account|saved jobs|my applications|log in|login|sign in|log out|sign out|register|sign up|"
    "create account|menu|search|language|events|stories|diversity|products|solutions|partners|shop|cart|"
    "startseite|stellensuche|stellen|stellenangebote|jobsuche|karriere|standorte|über uns|ueber uns|presse|aktuelles|profil|mein profil|merkliste|anmelden|registrieren|kontakt|menü|suche|studierende|"
    "accueil|carrières|offres|nos offres|nos sites|à propos|actualités|mes favoris|mon profil|connexion|inscription|presse|recherche|étudiants|nous connaître|"
    "inicio|empleo|empleos|quiénes somos|contacto|noticias|iniciar sesión|vacatures|over ons|nieuws|lavora con noi|chi siamo|contatti".split("|")
)
# Links of page footers.
LEGAL = set(
    "imprint|legal notice|legal|cookie settings|cookies|cookie policy|sitemap|site map|accessibility|accessibility statement|do not sell my data|do not sell or share my data|security|terms|terms of use|"
    "terms of service|terms and conditions|privacy|privacy policy|privacy notice|disclaimer|modern slavery statement|trust center|status|"
    "impressum|datenschutz|datenschutzerklärung|agb|barrierefreiheit|cookie-einstellungen|nutzungsbedingungen|rechtliches|"
    "mentions légales|confidentialité|politique de confidentialité|plan du site|accessibilité|gestion des cookies|conditions d'utilisation|cgu|aviso legal|privacidad|note legali".split("|")
)
# Buttons and controls.
BUTTONS = set(
    "apply|apply now|apply for this job|apply online|apply here|save job|save this job|save|print|print this page|email to a friend|send to a friend|refer someone|refer a friend|back to search results|back to results|"
    "back to jobs|back|report this posting|report this job|share|share this job|share this page|copy link|follow us|loading...|loading…|loading|skip to content|skip to main content|skip navigation|toggle navigation|close|"
    "open menu|next|previous|read more|show more|view all jobs|see all jobs|chat with our assistant|join our talent community|get job alerts|get job alerts by email|enter your email address|subscribe|"
    "jetzt bewerben|bewerben|merken|drucken|stelle teilen|teilen|zurück zur übersicht|zurück|stelle melden|anzeige melden|weiterempfehlen|folge uns|zum inhalt springen|newsletter abonnieren|jobs per e-mail erhalten|"
    "postuler|postuler maintenant|imprimer|ajouter aux favoris|partager cette offre|partager|retour aux résultats|retour|signaler cette offre|aller au contenu|suivez-nous|s'abonner à la lettre|recevoir les offres par e-mail|"
    "inscribirse|imprimir|compartir|solliciteren|candidati".split("|")
)
# Names in language switches.
LANGUAGES = set("en|de|fr|es|it|pt|nl|pl|sv|da|hi|english|english (us)|english (uk)|deutsch|français|español|italiano|português|nederlands|polski|svenska|dansk|हिन्दी|हिंदी|中文|日本語".split("|"))
# Networks named in prompts to share.
NETWORKS = set("linkedin|x|twitter|facebook|instagram|xing|youtube|whatsapp|email|e-mail|telegram|reddit".split("|"))
KNOWN = MENU | LEGAL | LANGUAGES
KNOWN_ITEMS = KNOWN | BUTTONS | NETWORKS
#: Decisions on lines met before; emptied when it grows beyond this.
MEMORY = 50_000
# Headings of lists of other roles.
OTHER_ROLES = re.compile(
    r"^(?:similar (?:jobs|roles|positions)|related (?:jobs|roles)|recently viewed(?: jobs)?|recent jobs|you may also like|people also viewed|more (?:roles|jobs|openings) (?:at|from) .{1,60}|other (?:jobs|roles|openings).{0,40}|recommended (?:jobs|for you)|"
    r"weitere (?:angebote|stellen|stellenangebote)|ähnliche (?:stellen|jobs|angebote)|zuletzt angesehen|das könnte dich auch interessieren|mehr stellen bei .{1,60}|andere suchten auch|"
    r"offres similaires|voir aussi|autres offres.{0,40}|vu récemment|récemment consultées?|vous aimerez aussi|empleos similares|vergelijkbare vacatures)\s*:?$"
)
# Labels of facts and headings that end a list of other roles.
OWN_LABEL = re.compile(
    r"^(?:location|standort|arbeitsort|lieu|salary|gehalt|salaire|reports to|teams?|job reference|reference|home office|start|contact for this role|contact|about the team|students welcome|the role|your work|what you will do|responsibilities|"
    r"requirements|qualifications|you bring|who we look for|benefits|perks (?:and|&) pay|what we offer|how to apply|next steps|process|deine rolle|aufgaben|das bringst du mit|wir bieten|vorteile|votre profil|vos missions|le poste|nos avantages|ce que nous offrons)\s*(?::.*)?$"
)
SEPARATORS = re.compile(r"\s*[|·•/>›»▸]\s*|\s{2,}|\t|\s+[-–—]\s+")
# Sentences of notices, consent texts, prompts and footers.
NOTICES = re.compile(
    r"^(?:we(?: and our partners)? use cookies\b|this (?:web)?site (?:uses|stores|places|sets) (?:cookies|small files|trackers)|tracking technologies help us|your choices matter: we only|by continuing to (?:browse|use)\b|with your (?:permission|consent), we and\b|"
    r"we value your privacy|mit deiner (?:zustimmung|einwilligung)\b|mit ihrer (?:zustimmung|einwilligung)\b|wir (?:verwenden|nutzen) cookies|diese (?:seite|website) (?:verwendet|nutzt|speichert)|"
    r"avec votre accord, (?:nos partenaires|nous)|ce site (?:dépose|utilise) des (?:traceurs|cookies)|nous utilisons des (?:cookies|traceurs)|utilizamos cookies|"
    r"sign up for our newsletter|subscribe to our|get job alerts|join our talent|enter your e-?mail|follow us\b|chat with our|was this page helpful|did you find|share this (?:job|page|role)\b|"
    r"stelle teilen|newsletter abonnieren|war diese seite hilfreich|cette page vous a-t-elle aidé|partager cette offre|"
    r"browse \d[\d,.]* open|you have viewed \d+ |our monthly letter (?:tells|presents)|\d[\d,.]* other people (?:looked|viewed)|read how .{1,80} in our stories section|compare salaries for\b|create a profile to|"
    r"du hast \d+ anzeigen gesehen|unser rundbrief\b|vous avez consulté \d+ annonces|notre lettre mensuelle\b|"
    r"(?:©|\(c\)\s|copyright\b)|powered by\b|job board software by|applicant tracking(?: by|:)|bewerbermanagement\b|propulsé par|beware of fraud\b|the information on this (?:web)?site is provided|this site is best viewed|"
    r"sitz der gesellschaft\b|siège social\b|diese seite wird bereitgestellt|logiciel de recrutement\b|stellenbörse von\b)"
    r"|(?:is a registered trade ?mark\.?|all rights reserved\.?|alle rechte vorbehalten\.?|tous droits réservés\.?|is registered in .{1,60} under number .{1,60}|without warranty.{0,60}|calls may be recorded\.?)$"
    r"|(?:[.:?!]\s*|^)(?:accept all|reject non-essential|reject all|manage preferences(?: \| ok)?|alle akzeptieren|nur notwendige|einstellungen anpassen|mehr in der datenschutzerklärung\.?|tout accepter|paramétrer|continuer sans accepter)$"
)
ROOT = r"(?:home|careers?|jobs?|all jobs|search jobs|startseite|karriere|stellen(?:angebote|suche)?|accueil|carrières|offres|emplois|inicio|empleos?|vacatures)"
PATHS = re.compile(rf"^{ROOT}\s*[>/»›▸]\s*\S.*$|^.{{1,120}}\s[<‹«←]\s*(?:back|zurück|retour|volver)$|^[<‹«←]\s*(?:back|zurück|retour)\b.*$")
PLACES_OF_FIRMS = re.compile(r"^(?:life at|leben bei|arbeiten bei|la vie chez|vivre chez|vida en) .{1,60}$")
LINK_MARK = re.compile(r"(?:\s*[▾▼]|\s+[>›]|\s*\(opens in a new (?:tab|window)\))$|^\[.*\]$", re.I)
BULLET = re.compile(r"^\s*(?:[-*•–—·▪●○‣]|»)\s+")
ADDRESS = re.compile(r"^[^,.:!?|]{2,80}, [^,.:!?|]{2,40}, [^\W\d_][^,.:!?|\d]{2,40}$")


def plain(text: str) -> str:
    """Case-folded text of a line without bullet and marks of links."""
    t = text.replace(" ", " ").strip()
    t = BULLET.sub("", t)
    t = LINK_MARK.sub("", t) if not t.startswith("[") else t[1:-1] if t.endswith("]") else t
    return t.strip().casefold()


def is_site(text: str) -> bool:
    """True for a line that is, by itself, of the site and not of the role."""
    if LINK_MARK.search(text.strip()):
        return True
    t = plain(text)
    if not t:
        return False
    flat = re.sub(r"\s+", " ", t)
    if NOTICES.search(flat) or PATHS.match(flat) or PLACES_OF_FIRMS.match(flat):
        return True
    if flat.rstrip(" :") in BUTTONS:
        return True
    if flat in KNOWN:
        return True
    items = [x for x in SEPARATORS.split(t) if x]
    if len(items) > 1 and all(x in KNOWN_ITEMS or PLACES_OF_FIRMS.match(x) for x in items):
        return True
    words = flat.split(" ")
    return len(words) > 1 and all(w in LANGUAGES for w in words)


SENTENCE_END = re.compile(r"[.!?…।][\"”’)\]]*$")
FACT = re.compile(r"^[^\W\d_][^:|]{0,40}:\s")
ROW = re.compile(r"\s*[|·•>›»▸]\s*|\s{2,}|\t")
SENTENCE_WORDS, LONG_WORDS, ITEM_WORDS = 3, 14, 6
LEAST_RUN = 3  # short lines that make a run at the head of a page


def shape(text: str) -> str:
    """What a rendered line looks like: 's' a sentence, 'f' a fact, with its label or a figure, 'r' a row of short items, 'i' a short line, 'o' another."""
    p = plain(text)
    size = len(p.split())
    if size >= LONG_WORDS or size >= SENTENCE_WORDS and SENTENCE_END.search(p):
        return "s"
    if FACT.match(f"{p} ") or OWN_LABEL.match(p) or re.search(r"\d", p) and not p.startswith(("©", "(c)")):
        return "f"
    items = [x for x in ROW.split(p) if x]
    if len(items) > 2 and all(len(x.split()) <= 4 for x in items):
        return "r"
    return "i" if size <= ITEM_WORDS else "o"


def told(text: str, memory: dict) -> tuple[str, bool, bool, str]:
    """(plain text, whether it opens a list of other roles, whether it is of the site by itself, shape) of a line; known ones from ``memory``."""
    got = memory.get(text)
    if got is None:
        if len(memory) > MEMORY:
            memory.clear()
        t = re.sub(r"\s+", " ", plain(text))
        got = memory[text] = (t, bool(OTHER_ROLES.match(t)), is_site(text), shape(text))
    return got


def laid_out(numbers: list[int], texts: dict[int, str], memory: dict | None = None) -> set[int]:
    """The lines that their place and layout alone tell to be of the site. numbers: of the lines with visible text, in order.

    Rows of three and more short items; in the lines before the first sentence or fact, a run of short lines
    up to a blank line, or all but the last two (title and heading) of a longer run; a path whose last part
    is a later line; and what comes after the last sentence, up to a fact or an own heading.
    """
    memory = {} if memory is None else memory
    known = {n: told(texts[n], memory) for n in numbers}
    kind = {n: known[n][3] for n in numbers}
    site = {n for n in numbers if kind[n] == "r"}
    sentences = [n for n in numbers if kind[n] == "s"]
    first = next((k for k, n in enumerate(numbers) if kind[n] in "sf"), len(numbers))
    head = numbers[:first]
    gap = next((k for k in range(1, len(head)) if head[k] > head[k - 1] + 1), 0)
    if gap >= LEAST_RUN:
        site.update(head[:gap])
    elif len(head) >= LEAST_RUN + 2:
        site.update(head[:-2])
    later = {known[n][0]: n for n in numbers}
    for n in numbers[: first + 1]:
        parts = [x for x in re.split(r"\s*[>/»›▸]\s*", known[n][0]) if x]
        if len(parts) > 1 and later.get(parts[-1], 0) > n:
            site.add(n)
    if sentences:
        k = len(numbers)
        while k and numbers[k - 1] > sentences[0] and (kind[numbers[k - 1]] in "iro" or numbers[k - 1] in site):
            k -= 1
        if len(numbers) - k > 1:
            site.update(numbers[k:])
    return site


def site_lines(source: str | None, memory: dict | None = None) -> list[int]:
    """Numbers of the lines of ``source`` that aren't blank and not the main text. memory: of lines met before."""
    if source is None:
        return []
    memory = {} if memory is None else memory
    raw = source.split("\n")
    seen: dict[int, tuple[str, bool]] = {}
    for p in pieces(source):
        text, site = seen.get(p.line, ("", True))
        # Words of one line that stand in separate cells or blocks keep their distance.
        seen[p.line] = (text + ("   " if text and (p.block or p.cell > 0) else "") + p.text, site and p.site)
    numbers = [n for n, row in enumerate(raw, 1) if row.strip()]
    placed = laid_out([n for n in numbers if n in seen], {n: seen[n][0] for n in seen}, memory)
    site: dict[int, bool] = {}
    listing = False
    for n in numbers:
        if n not in seen:
            site[n] = True  # markup or hidden text alone
            continue
        text, inside = seen[n]
        t, opens, alone, _ = told(text, memory)
        if opens:
            site[n] = listing = True
            continue
        site[n] = inside or alone or n in placed
        if listing and not site[n]:
            short = len(t) <= 90 and len(t.split()) <= 12 and not re.search(r"[.!?;]$", t)
            listing = short and not OWN_LABEL.match(t)
            site[n] = listing
    # The address of the firm at the page's foot.
    for n in reversed(numbers):
        if not site[n]:
            if n in seen and ADDRESS.match(plain(seen[n][0])) and n != numbers[0]:
                site[n] = True
                continue
            break
    return [n for n in numbers if site[n]]


def boilerplate_lines(df: DataFrame, value: str, key: str) -> DataFrame:
    """One row per ``key`` and line of the text column ``value`` that isn't main text: ``key``, ``line_no``.

    Lines are the parts between line feeds, from 1, blank ones counted but never given. Null and empty texts
    give no rows; texts of any length are judged whole. Equal texts are judged once and the result goes to
    every row that has them; repeated rows stay repeated. Other columns play no part.
    """
    rows = df.select(F.col(key).alias("__tm_key"), F.col(value).cast("string").alias("__tm_text")).where(F.length("__tm_text") > 0)
    rows = rows.withColumns({"__tm_x": F.xxhash64("__tm_text"), "__tm_y": F.xxhash64(F.lit(7919), "__tm_text")})
    texts = rows.select("__tm_x", "__tm_y", "__tm_text").dropDuplicates(["__tm_x", "__tm_y"])

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory: dict = {}
        for batch in batches:
            yield pd.DataFrame({"__tm_x": batch["__tm_x"], "__tm_y": batch["__tm_y"], "__tm_lines": [site_lines(t, memory) for t in batch["__tm_text"]]})

    judged = cut(texts.mapInPandas(judge, "__tm_x bigint, __tm_y bigint, __tm_lines array<int>").where(F.size("__tm_lines") > 0))
    out = guarded_join(rows.drop("__tm_text"), judged, ["__tm_x", "__tm_y"], "inner", "__tm_key")
    return out.select(F.col("__tm_key").alias(key), F.explode("__tm_lines").alias("line_no"))
