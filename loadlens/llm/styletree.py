"""Main text of web pages by a site style tree.

The block elements of all pages of a host are merged into one tree: a style node is
a path of element keys (tag, class and id with digits folded; no ids of headings, sections,
paragraphs and the like, which are often made from titles). For every style node
Spark counts the layouts (sequences of children) and the contents (own text) of its
occurrences, per host and over all hosts. The entropy of these counts, over the
largest it could have, is the node's presentation or content importance: what always
looks or reads alike says nothing. A branch's importance mixes its own presentation
with that of its children; a branch that is under ``LEAST`` with all below it is removed. Where
a host shows a node seldom, the tree of all hosts decides; else the lower of the two.

Roles are importances known beforehand: elements and class names for menus, headers,
footers, side bars, notices, adverts, forms, comments and invisible parts are 0 with
all below them; the article or main element is 1, and so is what is below it but for
the former (entropy there loses text, README). A name counts as a whole class or id, or as a part of one made of such names
only (``nav-menu``, not ``has-sidebar``), never on html and body. What is 0 but holds a main element, or is a form that
holds an article, is a wrapper and loses its role; so does what holds an article
on a page with no other main or article. Entropy decides about all else, and about all of a page without roles.

Text: character references decoded, white space inside a block one space, blocks in
page order joined by a newline.

Cases: a null or empty page gives an empty text; a null url, or one without host,
belongs to the host of no name; text without any element is a block; unclosed,
crossed and cut-off elements close as their parent does; repeated pages only lower
the entropy of what they repeat; an empty table gives no rows; only the three named
columns are read, so other columns may have any name.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import stored
from loadlens.llm.pretokens import Memo

#: Least importance of a branch, share of its own presentation per child, least occurrences on a host to judge by.
LEAST, GAMMA, SUPPORT = 0.5, 0.9, 20
#: Style nodes of all hosts together that are broadcast (some 10 MB); more are joined by host and salt.
BROADCAST_NODES, SALTS = 200_000, 32

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Nothing in them is markup; the second kind only where they are closed.
RAW, RAW_IF_CLOSED = frozenset(["script", "style"]), frozenset(["textarea", "title", "iframe"])
#: Noise whatever it holds.
INERT = RAW | RAW_IF_CLOSED | {"svg", "template"}
CELLS = frozenset("br mtr mtd mspace".split())
INLINE = frozenset("""math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover mmultiscripts mtable
    mtr mtd mspace mpadded mphantom menclose merror semantics annotation annotation-xml a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp
    small span strike strong sub sup time tt u var wbr""".split())
#: Elements that close an open one of the second set when they begin.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "body": {"head"}}
LISTS = frozenset("ul ol dl table select".split())
NOISE_TAGS = frozenset("nav footer aside form head header menu dialog button select option object canvas".split()) | INERT
MAIN_TAGS = frozenset(["article", "main"])
NOISE_NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation
    menu breadcrumb breadcrumbs header masthead topbar footer sidebar aside rail widget notice notices cookie cookies consent gdpr alert
    popup modal overlay comment comments disqus reply replies respond share sharing social related recommended recommendations
    newsletter subscribe subscription signup login search form pagination pager toolbar skip""".split())
#: Not cancelled by a name of main content.
STRONG_NAMES = frozenset("comment comments disqus reply replies respond sidebar footer nav navbar navigation menu".split())
MAIN_NAMES = frozenset("article content main post entry story".split())

#: Markup. No part of a tag crosses another "<" here, so that unclosed tags cost no more than they are long;
#: where the last form is found, Page._tag_end looks for the end past quoted values.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*+>|"
    r"<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>|<(/?)([a-zA-Z][^\s/<>]*+)", re.S)
UNQUOTED, UNTIL_SIGN = re.compile(r"[^<>\"']*+"), re.compile(r"[^<>]*+>")
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.I)

#: Their ids are no part of the key.
UNNAMED = frozenset("h1 h2 h3 h4 h5 h6 section p li dt dd tr td th figure blockquote pre".split())

PLAIN, NOISE, MAIN = 0, 1, 2
#: Elements nested deeper have no style node of their own, but that at this depth.
DEPTH = 500


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


def _named_noise(names: str) -> bool:
    """Whether classes and ids name noise; a name of main content cancels the weaker ones."""
    noise, main = set(), set()
    for token in names.split():
        words = set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()))
        main |= words & MAIN_NAMES
        if words <= NOISE_NAMES | MAIN_NAMES:
            noise |= words & NOISE_NAMES
    return bool(noise) and (not main or bool(noise & STRONG_NAMES))


def _role(tag_and_rest: tuple[str, str]) -> tuple[str, int]:
    """Key and role of an element from its tag and attributes."""
    tag, rest = tag_and_rest
    names, keys, hidden, main = [], [], False, tag in MAIN_TAGS
    for name, *values in ATTRIBUTE.findall(rest) if rest.strip(" /") else ():
        value = next((v for v in values if v), "")
        name = name.lower()
        if name in ("class", "id"):
            names.append(re.sub(r"\d+", "0", value))
            if name == "class" or tag not in UNNAMED:
                keys.append(names[-1])
        elif name == "role":
            main |= value == "main"
            hidden |= value in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert")
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = True
    noise = tag in NOISE_TAGS or hidden or tag not in ("html", "body") and _named_noise(" ".join(names))
    return ".".join([tag, *keys]), NOISE if noise and not main else MAIN if main else PLAIN


class Page:
    """The blocks and style nodes of one page."""

    def __init__(self, roles: Memo, paths: Memo):
        self.roles, self.paths = roles, paths

    def read(self, text: str) -> list[tuple[int, int, str]]:
        """Blocks ``(path, role, text)`` in page order; ``nodes`` gets (path, parent, depth, layout, content) of each element."""
        self.blocks: list[tuple[int, int, str]] = []
        self.nodes: list[tuple[int, int, int, int, int]] = []
        self.elements: list[list] = []  # of each element in page order: tag, its own role, element above, whether it holds a main, an article
        self.stack = [["", 0, -1, [], []]]  # tag, path, element, children, own text
        self.open: dict[str, list[int]] = defaultdict(list)  # places in the stack by tag
        self.ends: dict[int, int] = {}  # of tags, by the place of a quote in them
        buffer: list[str] = []
        at = done = 0
        while True:
            tag = TAG.search(text, at)
            if not tag:
                break
            start, at = tag.start(), tag.end()
            close, name, rest = tag[1], tag[2], tag[3]
            if tag[5]:
                end = self._tag_end(text, at)
                if end < 0:
                    continue  # no tag, but text
                close, name, rest, at = tag[4], tag[5], text[at:end], end + 1
            buffer.append(text[done:start])
            done = at
            if not name:
                continue
            name = name.lower()
            if name in INLINE:
                if name in CELLS:
                    buffer.append(" ")
                continue
            self._flush(buffer)
            if close:
                self._end(name)
                continue
            if name in RAW or name in RAW_IF_CLOSED:
                end = re.compile(rf"</{name}\b[^<>]*+>" if name in RAW else rf"<(/?){name}\b[^<>]*+>", re.I).search(text, at)
                if name in RAW or end and end[1]:
                    done = at = end.end() if end else len(text)
                    continue
            if name not in VOID:
                self._begin(name, rest)
                if rest.endswith("/") and name not in ("p", "div", "li", "td", "section", "article"):
                    self._end(name)
        buffer.append(text[done:])
        self._flush(buffer)
        while len(self.stack) > 1:
            self._pop()
        roles = self._settled()
        self.blocks = [(path, roles[element], words) for path, element, words in self.blocks]
        return self.blocks

    def _tag_end(self, text: str, at: int) -> int:
        """Place of the ">" of a tag whose name ends at ``at``: past quoted values, else the next before another "<"; -1 if none."""
        begin, passed, found = at, [], -1
        while True:
            at = UNQUOTED.match(text, at).end()
            sign = text[at:at + 1]
            if sign == ">":
                found = at
            if sign in ("", "<", ">"):
                break
            if at in self.ends:  # each quote is followed once, so the time is linear
                found = self.ends[at]
                break
            passed.append(at)
            at = text.find(sign, at + 1) + 1
            if not at:
                break
        self.ends.update(dict.fromkeys(passed, found))
        if found < 0:
            plain = UNTIL_SIGN.match(text, begin)
            found = plain.end() - 1 if plain else -1
        return found

    def _settled(self) -> list[int]:
        """Role of each element, now that all is read; the last is that of the page, for element -1."""
        free = self._roles(lambda tag, holds_main, holds_article: False)
        if MAIN not in free and any(x[1] == MAIN for x in self.elements):
            return self._roles(lambda tag, holds_main, holds_article: holds_main or holds_article)
        if any(x[1] == NOISE and (x[3] or x[4] and x[0] == "form") for x in self.elements):
            return self._roles(lambda tag, holds_main, holds_article: holds_main or holds_article and tag == "form")
        return free

    def _roles(self, wraps: Callable[[str, bool, bool], bool]) -> list[int]:
        roles = [PLAIN] * (len(self.elements) + 1)
        for i, (tag, own, up, holds_main, holds_article) in enumerate(self.elements):
            above = roles[up]
            if own == NOISE and tag not in INERT and wraps(tag, holds_main, holds_article):
                own = PLAIN
            roles[i] = (NOISE if above == NOISE or own == NOISE and not (above == MAIN and tag == "header")
                        else MAIN if MAIN in (above, own) else PLAIN)
        return roles

    def _flush(self, buffer: list[str]) -> None:
        raw = "".join(buffer)
        buffer.clear()
        words = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
        if words:
            top = self.stack[-1]
            top[4].append(words)
            self.blocks.append((top[1], top[2], words))

    def _begin(self, name: str, rest: str) -> None:
        if name in CLOSES:
            self._close_open(CLOSES[name], LISTS if name != "body" else ())
        self._close_open({"p"}, LISTS | {"td", "th", "div", "section", "article"})
        key, role = self.roles[name, rest]
        _, parent, above, children, own = self.stack[-1]
        deep = len(self.stack) > DEPTH
        path = parent if deep else self.paths[parent, key]
        if not deep and (not children or children[-1] != path):
            children.append(path)
        element, i = len(self.elements), above
        self.elements.append([name, role, above, False, False])
        if role == MAIN:
            held = 4 if name == "article" else 3
            while i >= 0 and not self.elements[i][held]:
                self.elements[i][held] = True
                i = self.elements[i][2]
        self.open[name].append(len(self.stack))
        self.stack.append([name, path, element, children, own] if deep else [name, path, element, [], []])

    def _close_open(self, names: set[str], bounds: Iterable[str]) -> None:
        at = max((self.open[n][-1] for n in names if self.open[n]), default=0)
        if at and at > max((self.open[n][-1] for n in bounds if self.open[n]), default=0):
            while len(self.stack) > at:
                self._pop()

    def _end(self, name: str) -> None:
        if self.open[name]:
            while self._pop() != name:
                pass

    def _pop(self) -> str:
        name, path, element, children, own = self.stack.pop()
        self.open[name].pop()
        if own is self.stack[-1][4]:  # deeper than DEPTH
            return name
        layout = xxhash.xxh64_intdigest(repr(children), 1) >> 1
        content = xxhash.xxh64_intdigest("\n".join(own), 2) >> 1 if own else 0
        self.nodes.append((path, self.stack[-1][1], len(self.stack), layout, content))
        return name


def _reader() -> Page:
    return Page(Memo(_role, 20_000), Memo(lambda x: xxhash.xxh64_intdigest(f"{x[0]} {x[1]}") >> 1, 50_000))


# ------------------------------------------------------------------ the tree

def style_counts(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``host, path, parent, depth, kind, feature, n``: occurrences of each layout (kind 0) and content (kind 1).

    Each task adds up first.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page = _reader()
        for batch in batches:
            counts: Counter = Counter()
            for url, cell in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page.read(cell.as_py())
                host = host_of(url)
                for path, parent, depth, layout, content in page.nodes:
                    counts[host, path, parent, depth, 0, layout] += 1
                    if content:
                        counts[host, path, parent, depth, 1, content] += 1
            keys = list(zip(*counts)) or [[]] * 6
            yield pa.record_batch([pa.array(keys[0], pa.string()), pa.array(keys[1], pa.int64()), pa.array(keys[2], pa.int64()),
                                   pa.array(keys[3], pa.int32()), pa.array(keys[4], pa.int32()), pa.array(keys[5], pa.int64()),
                                   pa.array(list(counts.values()), pa.int64())], ["host", "path", "parent", "depth", "kind", "feature", "n"])

    plain = pages.select(F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("t"))
    made = plain.mapInArrow(run, "host string, path long, parent long, depth int, kind int, feature long, n long")
    return made.groupBy("host", "path", "parent", "depth", "kind", "feature").agg(F.sum("n").alias("n"))


def importances(counts: DataFrame, by_host: bool) -> DataFrame:
    """``[host, depth,] path, parent, n, presentation, content``: entropy over the largest possible, 1 for a single occurrence."""
    keys = ["host", "path", "parent", "depth"] if by_host else ["path", "parent"]
    c = counts if by_host else counts.groupBy("path", "parent", "kind", "feature").agg(F.sum("n").alias("n"))
    total, part = F.sum("n"), F.sum(F.col("n") * F.log("n"))
    one = c.groupBy(*keys, "kind").agg(total.alias("n"), part.alias("part"))
    entropy = F.when(F.col("n") > 1, (F.log("n") - F.col("part") / F.col("n")) / F.log("n")).otherwise(1.0)
    return one.withColumn("e", entropy).groupBy(*keys).agg(
        F.max("n").alias("n"), F.max(F.when(F.col("kind") == 0, F.col("e"))).alias("presentation"),
        F.max(F.when(F.col("kind") == 1, F.col("e"))).alias("content"))


def branch_importance(nodes: dict[int, tuple[int, float, float | None]]) -> tuple[dict[int, float], set[int]]:
    """Composite importance of the branches of one tree, and those to remove: where it is low
    in the branch and in all below it. ``nodes`` maps path to (parent, presentation, content)."""
    below: dict[int, list[int]] = {}
    for path, (parent, _, _) in nodes.items():
        below.setdefault(parent, []).append(path)
    out: dict[int, float] = {}
    low: set[int] = set()
    todo = [(p, False) for p, (parent, _, _) in nodes.items() if parent not in nodes]
    while todo:
        path, ready = todo.pop()
        children = below.get(path, ())
        if not ready:
            todo.append((path, True))
            todo += [(c, False) for c in children]
            continue
        _, presentation, content = nodes[path]
        parts = [out[c] for c in children] + ([content] if content is not None else [])
        weight = GAMMA ** len(parts) if parts else 0.0
        out[path] = (1 - weight) * presentation + weight * sum(parts) / len(parts) if parts else presentation
        if out[path] < LEAST and all(c in low for c in children):
            low.add(path)
    return out, low


def low_nodes(judged: DataFrame) -> DataFrame:
    """``host, path`` of what branch_importance removes from ``host, path, parent, depth, presentation, content``.

    Level by level from below: children are added up by (host, parent), so no task holds a host's tree.
    Below the deepest node with a value under 1 every importance is 1.
    """
    deepest = judged.where("presentation < 1 OR content < 1").agg(F.max("depth")).first()[0] or 0
    below = judged.where(F.col("depth") == deepest + 1).groupBy("host", F.col("parent").alias("path")).agg(
        F.count(F.lit(1)).alias("children"), F.count(F.lit(1)).cast("double").alias("total"), F.lit(False).alias("all_low"))
    own = F.col("content").isNotNull().cast("long")
    parts = F.coalesce("children", F.lit(0)) + own
    weight = F.pow(F.lit(GAMMA), parts)
    mean = (F.coalesce("total", F.lit(0.0)) + F.coalesce("content", F.lit(0.0))) / F.greatest(parts, F.lit(1))
    importance = F.when(parts > 0, (1 - weight) * F.col("presentation") + weight * mean).otherwise(F.col("presentation"))
    levels = []
    for depth in range(deepest, 0, -1):
        level = stored(judged.where(F.col("depth") == depth).join(below, ["host", "path"], "left").select(
            "host", "path", "parent", importance.alias("importance"),
            ((importance < LEAST) & F.coalesce("all_low", F.lit(True))).alias("low")), "style-level")
        levels.append(level.where("low").select("host", "path"))
        below = level.groupBy("host", F.col("parent").alias("path")).agg(
            F.count(F.lit(1)).alias("children"), F.sum("importance").alias("total"), F.min("low").alias("all_low"))
    return reduce(DataFrame.unionByName, levels, judged.select("host", "path").limit(0))


def removed_nodes(counts: DataFrame) -> DataFrame:
    """``host, removed``: style nodes of low importance, host by host."""
    own = importances(counts, by_host=True)
    every = importances(counts, by_host=False).select("path", "parent", F.col("n").alias("all_n"), F.col("presentation").alias("all_p"),
                                                      F.col("content").alias("all_c"))
    def at_least(own_value: str, all_value: str) -> Column:
        return F.when(F.col("n") >= SUPPORT, F.least(own_value, all_value)).when(F.col("all_n") >= SUPPORT, F.col(all_value)).otherwise(1.0)

    judged = own.join(every, ["path", "parent"]).select(
        "host", "path", "parent", "depth", at_least("presentation", "all_p").alias("presentation"),
        F.when(F.col("content").isNotNull(), at_least("content", "all_c")).alias("content"))
    return low_nodes(stored(judged, "style-judged")).groupBy("host").agg(F.collect_list("path").alias("removed"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``<id_col>, <url_col>, text`` of every page."""
    counts = stored(style_counts(pages, url_col, html_col), "style-counts")
    removed = stored(removed_nodes(counts), "style-removed")
    size = removed.agg(F.coalesce(F.sum(F.size("removed")), F.lit(0))).first()[0]
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    plain = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("t")).withColumn("host", host)
    if size <= BROADCAST_NODES:
        both = plain.join(F.broadcast(removed), "host", "left")
    else:
        salted = removed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = plain.withColumn("salt", F.pmod(F.xxhash64("id", "t"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page = _reader()
        for batch in batches:
            texts = []
            for cell, low in zip(batch.column(2), batch.column(3), strict=True):
                texts.append(extract(page, cell.as_py(), low.as_py()))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])

    kind = plain.schema["id"].dataType.simpleString()
    out = both.select("id", "url", "t", "removed").mapInArrow(run, f"id {kind}, url string, text string")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})


def extract(page: Page, text: str, removed: list[int] | None) -> str:
    """The text of the blocks that stay; a removed style node takes all below it along."""
    blocks = page.read(text)
    low = set(removed or ())
    if low:
        parents = {path: parent for path, parent, _, _, _ in page.nodes}
        gone: dict[int, bool] = {0: False}

        def is_gone(path: int) -> bool:
            chain = []
            while path not in gone:
                chain.append(path)
                if path in low:
                    gone[path] = True
                    break
                path = parents.get(path, 0)
            for p in chain:
                gone[p] = gone[path]
            return gone[path]

        blocks = [b for b in blocks if b[1] == MAIN or b[1] == PLAIN and not is_gone(b[0])]
    return "\n".join(words for _, role, words in blocks if role != NOISE)
