"""Main text of web pages by equivalence-class template deduction.

1. Tokens.  A page is a row of tags and text nodes, told apart by the path they stand on.  For every host and token
   Spark sums up in how many pages it is and a hash of its occurrence vector (how often it is in each page).
2. Classes.  Tokens of a host with equal vectors form an equivalence class; frequent ones are kept.  A second pass
   keeps those that are valid: on SUPPORT of their pages their tokens come in one order and lie in one gap of the
   classes around them.  These nested classes are the host's template.
3. Slots.  What stands between template tokens are slots.  Pages vote for the slot that has most of their text, and
   for its frame: the widest element around it in which no branch beside it holds template text or mostly links.
4. A third pass reads the article from the slots in the frame.

Only sums for (host, token) are shuffled, so neither hot hosts nor long pages gather anywhere, and what a page gives
depends on its host's pages alone.  Hosts with fewer than LEAST_PAGES pages with a text have no template; their slots
are told by how much text they hold and by the words that elements are marked with.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from itertools import zip_longest

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import bounded_batches, lookup_join, materialize

#: A token is frequent if so many pages of the host have it, and one page in so many.
LEAST_PAGES, FREQUENT = 5, 50
#: Text nodes on so large a part of a host's pages are template text; classes need one form on as large a part.
SUPPORT = 0.8
#: What a character in a link, and in an element marked as an article, is worth when slots are compared.
LINK_WORTH, ARTICLE_WORTH = 0.2, 3.0
#: Sums a task holds before it hands them on; the size up to which a table of templates is broadcast.
TOKENS_HELD, BROADCAST_BYTES = 200_000, 32 << 20
MASK, HALF = (1 << 64) - 1, (1 << 31) - 1

#: Element names by what they do, and words in class, id or role that mark what is no article.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe svg math textarea title object canvas audio video noembed noframes xmp".split())
LEFT_OUT = frozenset("nav header footer aside form menu dialog button select option datalist label fieldset".split())
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
MARKS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsbygoogle banner breadcrumb breadcrumbs byline comment comments commentlist "
    "consent cookie cookies cta dialog disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification pager pagination popup promo promoted related reply replies respond rail recommended search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe tags teaser toolbar widget widgets complementary contentinfo alert alertdialog".split()
)
ARTICLE_WORDS = frozenset("article articlebody content entry main post story".split())

TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)|<!(?!--)[^>]*+>?|<\?[^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")


@dataclass
class Token:
    role: str  # path and name of a tag, or path and text of a text node
    text: str | None
    block: int
    region: str  # "out" of any article, "article", "main" or "content"
    dropped: bool
    link: bool = False


@dataclass
class Page:
    tokens: list[Token] = field(default_factory=list)


def marks_of(attributes: str) -> tuple[frozenset, str]:
    words, first = set(), ""
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        value = value.strip("\"'")
        if name in ("class", "id", "role"):
            own = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower())
            words.update(own)
            if name == "role":
                words.update({"role-" + x for x in own})
            if name == "class" and not first:
                first = ".".join(value.split()[:2])
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            words.add("-hidden")
    return frozenset(words), first


def parse(html: str) -> Page:
    """Tokens of a page, forgiving: unclosed and stray tags never make it fail."""
    page, stack, block, at, raw = Page(), [], 0, 0, None  # stack: (name, path, region, dropped)
    path, region, dropped, link = "", "out", False, False

    def settle():
        nonlocal path, region, dropped
        path, region, dropped = stack[-1][1:] if stack else ("", "out", False)

    def text(part: str):
        if part and not part.isspace():
            part = (entities.unescape(part) if "&" in part else part) or " "
            core = " ".join(part.split())
            spaced_out = " " * part[0].isspace() + core + " " * (part[-1].isspace() and core != "")
            page.tokens.append(Token(f"{path}#{core}", spaced_out, block, region, dropped, link))
        elif part and page.tokens and page.tokens[-1].text is not None and page.tokens[-1].block == block:
            page.tokens[-1].text += " "

    for m in TOKENS.finditer(html):
        if m.start() < at:
            continue
        if raw is None:
            text(html[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        link = not m[1] if name == "a" else link and name not in BLOCKS  # an unclosed link ends with its block
        if m[1]:
            hit = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if hit is not None:
                del stack[hit:]
                settle()
            if name in BLOCKS:
                block += 1
            continue
        words, first = marks_of(m[3]) if m[3].strip() else (frozenset(), "")
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at) if not m[3].endswith("/") else None
            if not m[3].endswith("/"):
                at = end.end() if end else len(html)
            if name == "title" or not end:
                block += name == "title"
            continue
        if name == "br":
            if page.tokens and page.tokens[-1].text is not None and page.tokens[-1].block == block:
                page.tokens[-1].text += " "
            continue
        if name in BLOCKS:
            block += 1
            if stack and name not in ("html", "body"):
                for i in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph
                    if stack[i][0] == "p":
                        del stack[i:]
                        break
                    if stack[i][0] in BLOCKS:
                        break
            if name in CLOSED_BY:
                closes, within = CLOSED_BY[name]
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in closes:
                        del stack[i:]
                    elif stack[i][0] in within:
                        break
            settle()
        marked = bool(words & MARKS) or "-hidden" in words
        if name in VOID or (name not in BLOCKS and not marked and name not in LEFT_OUT):
            continue
        if name in ("html", "body"):
            marked = False
        role = f"{path}/{name}" + (f".{first}" if first else "")
        now, out = region, dropped or marked
        if name == "article" and not out:
            now = "article"
        elif (name == "main" or "role-main" in words) and not out and region == "out":
            now = "main"
        elif words & ARTICLE_WORDS and name in BLOCKS and name not in ("html", "body") and not out and region == "out":
            now = "content"
        if name in LEFT_OUT and not (name == "header" and region == "article"):
            out = True
        page.tokens.append(Token(role, None, block, now, out))
        stack.append((name, role, now, out))
        settle()
    text(html[at:])
    return page


def spaced(h: int) -> int:
    """Finalizer of splitmix64, on Python integers."""
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & MASK
    h = (h ^ h >> 27) * 0x94D049BB133111EB & MASK
    return h ^ h >> 31


def role_id(role: str) -> int:
    """A signed 64-bit id of a token's role; never 0, which stands for the page itself."""
    return (xxhash.xxh3_64_intdigest(role.encode("utf-8", "surrogatepass")) or 1) - (1 << 63)


class Roles(dict):
    """Ids of roles, kept for those that come again; a task forgets them all when there are too many."""

    def __missing__(self, role: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[role] = found = role_id(role)
        return found


def token_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each host and token: pages that have it, two sums that stand for its occurrence vector, its highest count.

    A vector's sums add a hash of (page, count) for every page with the token, so tokens with equal vectors have
    equal sums whatever the order of pages and however they are dealt.  Role 0 counts the pages that have a text.
    """
    held: dict[tuple, list] = {}
    ids = Roles()

    def part() -> pd.DataFrame:
        rows = [(*k, *v) for k, v in held.items()]
        return pd.DataFrame(rows, columns=["host", "role", "is_text", "pages", "a", "b", "most"])

    for pdf in batches:
        for host, seed, html in zip(pdf["host"], pdf["seed"], pdf["html"]):
            page = parse(html or "")
            if not any(t.text is not None for t in page.tokens):
                continue
            counts = Counter((t.role, t.text is not None) for t in page.tokens)
            marks: dict[int, int] = {}
            for (role, is_text), n in (*counts.items(), (("", False), 1)):
                h = marks.get(n)
                if h is None:
                    h = marks[n] = spaced((seed ^ n * 0x9E3779B97F4A7C15) & MASK)
                key = (host, ids[role] if role else 0, is_text)
                row = held.get(key)
                if row is None:
                    held[key] = [1, h & HALF, h >> 31 & HALF, n]
                else:
                    row[0] += 1
                    row[1] += h & HALF
                    row[2] += h >> 31 & HALF
                    row[3] = max(row[3], n)
            if len(held) > TOKENS_HELD:
                yield part()
                held.clear()
    yield part()


def deduced_classes(parts: DataFrame) -> DataFrame:
    """(host, class, roles, texts, host_pages): the frequent equivalence classes of each host.

    roles are the class's tags, texts its text nodes that count as template text: those of a class with a tag, or on
    SUPPORT of all pages.  Frequent is what LEAST_PAGES pages have, and one in FREQUENT of the host's.
    """
    sums = parts.groupBy("host", "role", "is_text").agg(F.sum("pages").alias("pages"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    sums = materialize(sums.filter(F.col("pages") >= LEAST_PAGES), "page-tokens")
    hosts = sums.filter("role = 0").select("host", F.col("pages").alias("host_pages"), F.col("pages").alias("weight"))
    found = lookup_join(sums.filter("role <> 0"), hosts, "host", "weight").filter(F.col("pages") * FREQUENT >= F.col("host_pages"))
    own = F.col("is_text")
    classes = found.groupBy("host", F.xxhash64("a", "b").alias("class")).agg(
        F.collect_list(F.when(~own, F.col("role"))).alias("roles"), F.collect_list(F.when(own, F.col("role"))).alias("texts"),
        F.max("pages").alias("pages"), F.max("host_pages").alias("host_pages"),
    )
    telling = (F.size("roles") > 0) | (F.col("pages") >= F.col("host_pages") * SUPPORT)
    classes = classes.withColumn("texts", F.when(telling, F.col("texts")).otherwise(F.array().cast("array<long>")))
    return classes.filter((F.size("roles") > 0) | (F.size("texts") > 0))


def encoded(classes: DataFrame) -> DataFrame:
    """(host, template): a host's classes as one string, the widest first; bounded by FREQUENT times a page's tokens."""
    line = F.concat_ws(";", F.col("class"), F.concat_ws(",", "roles"), F.concat_ws(",", "texts"))
    lines = F.array_sort(F.collect_list(F.struct(-F.col("pages"), -F.size("roles"), F.col("class"), line.alias("line"))))
    return classes.groupBy("host").agg(F.concat_ws("|", F.transform(lines, lambda x: x["line"])).alias("template"), F.max("host_pages").alias("weight"))


@dataclass
class Template:
    """What is known of a host: the rank of each class's tags, its texts, and how often a slot held a page's most text."""

    rank: dict[int, int] = field(default_factory=dict)
    classes: list[int] = field(default_factory=list)
    tags: set[int] = field(default_factory=set)
    texts: set[int] = field(default_factory=set)
    votes: dict[int, int] = field(default_factory=dict)

    @classmethod
    def read(cls, template: str | None, votes: str | None = None) -> Template:
        out = cls()
        for k, line in enumerate((template or "").split("|") if template else ()):
            name, roles, texts = line.split(";")
            out.classes.append(int(name))
            roles, texts = ({int(x) for x in s.split(",") if x} for s in (roles, texts))
            out.tags |= roles
            out.texts |= texts
            out.rank |= dict.fromkeys(roles | texts, k)
        for pair in (votes or "").split(","):
            if pair:
                name, n = pair.split(":")
                out.votes[int(name)] = int(n)
        return out


class Templates(dict):
    """Decoded templates of the hosts that a task has met."""

    def of(self, host: str, *encoded: str | None) -> Template:
        found = self.get(host)
        if found is None:
            if len(self) > 2000:
                self.clear()
            found = self[host] = Template.read(*encoded)
        return found


def ancestors(path: str) -> list[str]:
    """The path and all paths above it, outermost first."""
    parts = path.split("/")
    return ["/".join(parts[:i]) for i in range(1, len(parts) + 1)]


class Slots:
    """Which slot a text node of a host's pages is in: the innermost template tag around it.

    Where the template has no tag above it, the element around its block stands for the slot.
    """

    def __init__(self, template: Template, ids: Roles):
        self.template, self.ids, self.known = template, ids, {}

    def __call__(self, t: Token) -> str:
        path = t.role.partition("#")[0]
        slot = self.known.get(path)
        if slot is None:
            tags = [a for a in ancestors(path)[1:] if self.ids[a] in self.template.tags]
            slot = self.known[path] = tags[-1] if tags else path.rpartition("/")[0]
        return slot


def unnamed(page: Page) -> Page:
    """The page as if no element called itself an article, an advert, a menu or the like."""
    for t in page.tokens:
        t.region, t.dropped = "out", False
    return page


class Branches:
    """Where a page's text parts from the way to its main slot: by level and branch, and what is bad about a branch.

    A branch is bad that holds template text, or more text in links than outside of them.
    """

    def __init__(self, page: Page, main: str, slot_of: Slots):
        self.above, self.known = ancestors(main), {}
        share: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0])
        self.bad: set[tuple] = set()
        for t in page.tokens:
            if t.text is None:
                continue
            branch = self(t)
            if branch is None:
                continue
            if slot_of.ids[t.role] in slot_of.template.texts:
                self.bad.add(branch)
            if not t.dropped:
                share[branch][t.link] += len(t.text)
        self.bad |= {b for b, (plain, link) in share.items() if link > plain}

    def __call__(self, t: Token) -> tuple | None:
        """(level, branch) of a text node; None for those in the main slot, and on the way to it."""
        path = t.role.partition("#")[0]
        if path not in self.known:
            own = ancestors(path)
            level = next((i for i, (a, m) in enumerate(zip_longest(own, self.above)) if a != m), None)
            on_the_way = level is None or level == len(self.above) or level == len(own)
            self.known[path] = None if on_the_way else (level, own[level])
        return self.known[path]

    def frame(self) -> str:
        """The widest element around the main slot without a bad branch in it."""
        level = max((level for level, _ in self.bad), default=0)
        return self.above[min(level, len(self.above) - 1)]


def frame_id(path: str) -> int:
    return role_id("frame " + path)


def held_text(page: Page, slot_of: Slots) -> dict[str, float]:
    """How much text each slot holds that is no template text; links count little, words that mark an article more."""
    held: dict[str, float] = defaultdict(float)
    for t in page.tokens:
        if t.text is not None and not t.dropped and slot_of.ids[t.role] not in slot_of.template.texts:
            held[slot_of(t)] += len(t.text) * (LINK_WORTH if t.link else 1.0) * (ARTICLE_WORTH if t.region != "out" else 1.0)
    return held


def forms_of(page: Page, template: Template, ids: Roles) -> dict[int, int]:
    """For each class on the page, a hash of its tokens' order and of the gap they stand in; 0 for several gaps.

    The gap is told by the nearest token before it that belongs to a wider class.
    """
    before: list[tuple[int, int]] = []  # ranks and roles of earlier tokens, each wider than the next
    seen: dict[int, list[int]] = defaultdict(list)
    gaps: dict[int, int | None] = {}
    for t in page.tokens:
        role = ids[t.role]
        k = template.rank.get(role)
        if k is None or (t.text is not None and role not in template.texts):
            continue
        while before and before[-1][0] >= k:
            before.pop()
        gap = before[-1][1] if before else 0
        if k not in gaps:
            gaps[k] = gap
        elif gaps[k] != gap:
            gaps[k] = None
        before.append((k, role))
        if role not in seen[k]:
            seen[k].append(role)
    return {template.classes[k]: 0 if gaps[k] is None else role_id(f"{roles}{gaps[k]}") for k, roles in seen.items()}


def form_parts(batches: Iterator[pd.DataFrame], named: bool = True) -> Iterator[pd.DataFrame]:
    """(host, kind, id, form, n): pages by the form a class has there ("c"), by the slot with most text and its frame ("v")."""
    held: Counter = Counter()
    ids, templates, slots = Roles(), Templates(), {}

    def part() -> pd.DataFrame:
        return pd.DataFrame([(*k, n) for k, n in held.items()], columns=["host", "kind", "id", "form", "n"])

    for pdf in batches:
        for host, html, encoded_template in zip(pdf["host"], pdf["html"], pdf["template"]):
            template = templates.of(host, encoded_template)
            page = parse(html or "") if named else unnamed(parse(html or ""))
            for name, form in forms_of(page, template, ids).items():
                held[host, "c", name, form] += 1
            slot_of = slots.get(host)
            if slot_of is None or slot_of.template is not template or len(slot_of.known) > 2000:
                if len(slots) > 2000:
                    slots.clear()
                slot_of = slots[host] = Slots(template, ids)
            text = held_text(page, slot_of)
            if text:
                main = max(text, key=lambda s: (text[s], s))
                held[host, "v", ids[main], 0] += 1
                held[host, "v", frame_id(Branches(page, main, slot_of).frame()), 0] += 1
            if len(held) > TOKENS_HELD:
                yield part()
                held.clear()
    yield part()


def main_text(page: Page, template: Template, slot_of: Slots | None = None) -> str:
    """The page's text in the slots that are its article.

    Its main slot is, among those that hold a quarter or more of what the fullest one holds, that which most pages of
    the host have most text in.  The article is what lies in the slot's frame, the element around it that most pages
    of the host vote for (where none is voted for, the page's own), without branches that hold template text or mostly
    links.  If the main slot is in an element which calls itself an article, the texts in such elements are the
    article.  Elements that call themselves adverts, menus and so on are left out wherever they stand.  Without a
    template all but the bad branches is the article.  Template text inside the article goes, unless it is more than
    half of it: then the host's pages are copies of each other rather than one frame with different contents.
    """
    slot_of = slot_of or Slots(template, Roles())
    held = held_text(page, slot_of)
    texts = [t for t in page.tokens if t.text is not None and not t.dropped]
    if not held:  # nothing but template text
        held = {slot_of(t): 0.0 for t in texts}
        if not held:
            return ""
    least = max(held.values()) / 4
    main = max((s for s in held if held[s] >= least), key=lambda s: (template.votes.get(slot_of.ids[s], 0), held[s], s))
    fixed = {id(t) for t in page.tokens if t.text is not None and slot_of.ids[t.role] in template.texts}
    regions = Counter()
    for t in texts:
        if slot_of(t) == main:
            regions[t.region] += len(t.text)
    region = max(regions, key=lambda r: (regions[r], r)) if regions else "out"
    if region != "out":
        kept = [t for t in texts if t.region == region]
    else:
        branches = Branches(page, main, slot_of)
        kept = [t for t in texts if branches(t) not in branches.bad]
        if template.tags:
            voted = [a for a in branches.above if frame_id(a) in template.votes]
            frame = max(voted, key=lambda a: (template.votes[frame_id(a)], a)) if voted else branches.frame()
            kept = [t for t in kept if f"{t.role.partition('#')[0]}/".startswith(frame + "/")]
    own = sum(len(t.text) for t in kept if id(t) not in fixed)
    if 2 * own >= sum(len(t.text) for t in kept):
        kept = [t for t in kept if id(t) not in fixed]
    parts: dict[int, list[str]] = {}
    for t in kept:
        parts.setdefault(t.block, []).append(t.text)
    lines = (" ".join("".join(x).split()) for x in parts.values())
    return "\n".join(x for x in lines if x)


def text_parts(batches: Iterator[pd.DataFrame], named: bool = True) -> Iterator[pd.DataFrame]:
    ids, templates, slots = Roles(), Templates(), {}
    for pdf in batches:
        made = []
        for host, html, encoded_template, votes in zip(pdf["host"], pdf["html"], pdf["template"], pdf["votes"]):
            template = templates.of(host, encoded_template, votes)
            slot_of = slots.get(host)
            if slot_of is None or slot_of.template is not template or len(slot_of.known) > 2000:
                if len(slots) > 2000:
                    slots.clear()
                slot_of = slots[host] = Slots(template, ids)
            page = parse(html or "")
            made.append(main_text(page if named else unnamed(page), template, slot_of))
        yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": made, "n_chars": [len(x) for x in made]})


def host_of(url: Column) -> Column:
    """The authority of a URL without user, port and a leading www., lower-cased; empty if there is none."""
    authority = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(authority, r"^www\.", "")


def with_known(rows: DataFrame, known: DataFrame, how_many: str) -> DataFrame:
    """rows with their host's columns of known.  A table of less than BROADCAST_BYTES is broadcast; of a larger one
    only the part of hot hosts, the rest being joined by a shuffle."""
    size = known.agg(F.sum(sum((F.length(c) for c, t in known.dtypes if t == "string"), F.lit(64)))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(known.drop(how_many)), "host")
    return lookup_join(rows, known, "host", how_many)


def deduce_templates(rows: DataFrame, named: bool = True) -> DataFrame:
    """(host, template, votes, weight) of the hosts in rows (host, seed, html) with enough pages for a template."""
    parts = rows.mapInPandas(token_parts, "host string, role long, is_text boolean, pages long, a long, b long, most long")
    classes = materialize(deduced_classes(parts), "page-classes")
    candidates = materialize(encoded(classes), "page-candidates")
    forms = with_known(rows.select("host", "html"), candidates, "weight")
    forms = forms.mapInPandas(partial(form_parts, named=named), "host string, kind string, id long, form long, n long")
    forms = materialize(forms.groupBy("host", "kind", "id", "form").agg(F.sum("n").alias("n")), "page-forms")
    best = F.max(F.struct("n", "form"))
    shapes = forms.filter("kind = 'c'").groupBy("host", F.col("id").alias("class")).agg(best.alias("best"), F.sum("n").alias("all"))
    valid = shapes.filter((F.col("best.form") != 0) & (F.col("best.n") >= F.col("all") * SUPPORT)).select("host", "class")
    templates = encoded(classes.join(valid, ["host", "class"], "left_semi"))
    votes = forms.filter("kind = 'v'").groupBy("host", "id").agg(F.sum("n").alias("n"))
    # Slots with few votes would win no page against those with more; the fullest slot decides there anyway.
    votes = votes.join(candidates.select("host", "weight"), "host").filter(F.col("n") * FREQUENT >= F.col("weight"))
    votes = votes.groupBy("host").agg(F.concat_ws(",", F.array_sort(F.collect_list(F.concat_ws(":", "id", "n")))).alias("votes"))
    return materialize(templates.join(votes, "host", "full_outer").withColumn("weight", F.coalesce("weight", F.lit(1))), "page-templates")


def extract_main_text(pages: DataFrame, named: bool = True) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages (page_id, url, html).

    With named=False nothing that elements call themselves (article, menu, advert, ...) counts, only the template does.

    Nulls: null html gives the empty text, null urls are one host, null ids stay null.  Repeated rows are repeated, and
    count as further pages of their host.  Very long pages are read whole.  Ties between slots go to the one with more
    text, then to the greater path.  Texts do not depend on other columns, on the order of rows, or on other hosts.
    No rows give no rows.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"), F.xxhash64("page_id", "url", "html").alias("seed"))
    known = deduce_templates(rows.select("host", "seed", "html"), named)
    rows = rows.select("host", F.col("page_id").cast("string").alias("page_id"), "url", "html")
    empty = F.lit(None).cast("string")
    size = known.agg(F.sum(F.length(F.coalesce("template", F.lit(""))) + F.length(F.coalesce("votes", F.lit(""))) + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        rows = rows.join(F.broadcast(known.drop("weight")), "host", "left")
    else:
        few = rows.join(known.select("host"), "host", "left_anti").withColumns({"template": empty, "votes": empty})
        rows = lookup_join(rows, known, "host", "weight").unionByName(few)
    out = rows.mapInPandas(partial(text_parts, named=named), "page_id string, url string, text string, n_chars long")
    return out.withColumn("page_id", F.col("page_id").cast(pages.schema["page_id"].dataType))
