"""Main text of web pages by paths that the pages of a host agree on.

1. Each page's containers are scored by the paragraph text they hold (their own in
   full, what is n levels below by a 2**n-th), less links; the best one is the page's
   vote.
2. A vote names a generalised path: the tags from the root with their first class,
   digits as "#".  Spark adds the votes up per host; the heaviest path and all with a
   tenth of the host's votes are kept.
3. Each page is extracted again from the elements at its host's paths.  Its own best
   container is added if those hold little beside it.
4. From there the extraction climbs: the text of ancestors, and of other containers
   below them, belongs to the article where it has paragraphs or an h1 or h2 and is
   not mostly links.

Within the chosen elements, parts that are never the article are left out: menus,
asides, forms, scripts, and elements whose class or id says advert, comments,
sharing and the like.  Such a mark on html, body, or on a form or wrapper that is
the page itself does not count; where marks would leave next to nothing of a page with
paragraphs, none but the elements that are never the article count.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Container, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import slices, stage

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var img wbr rp rt ruby".split())
CONTAINERS = frozenset(
    "html head body div section article main nav header footer aside form ul ol dl table thead tbody tfoot "
    "blockquote figure details fieldset center menu template noscript iframe object button select dialog "
    "address svg".split())
RAW = ("script", "style", "textarea", "title", "noscript", "xmp")
NEVER = frozenset("head nav footer aside form menu template noscript iframe object button select dialog svg".split())
#: Words of a class, id or role that mark parts beside the article.
BESIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer comment comments respond disqus share sharing social related "
    "recommended newsletter subscribe subscription cookie cookies consent notice notices gdpr popup modal overlay "
    "widget toolbar pagination pager login signup search copyright disclaimer masthead complementary "
    "contentinfo".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?|[^<]+|<", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?|\"[^\"]*\"|'[^']*'")
#: First words of classes that tell a state of the page, as in has-sidebar.
STATES = frozenset("has no with without".split())
#: A marked container with more than HALF of the page's worth and its heading or main part, or with nearly ALL of
#: the worth, is the page itself and not a part beside the article.
HALF, ALL = 0.5, 0.9
#: A host's paths are those with at least one vote in so many.
SHARE = 10
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")


def _worth(text: str, linked: int) -> float:
    return max(0.0, len(text) - 2.0 * linked) * (1.0 if len(text) >= 40 else 0.3)


def _marks(name: str) -> bool:
    """Whether a word of a class, id or role marks a part beside the article."""
    parts = [p.lower() for p in _PART.findall(name)]
    return bool(parts) and parts[0] not in STATES and not BESIDE.isdisjoint(parts)


class Page:
    """Containers of one page in order, and its blocks of text with their container."""

    def __init__(self, source: str) -> None:
        self.paths: list[str] = [""]
        self.parent: list[int] = [-1]
        self.beside: list[bool] = [False]
        self.never: list[bool] = [False]
        self.marked: list[bool] = [False]  # by a class, id, role, hidden, or a form: own marks only
        self.tags: list[str] = [""]
        self.heads: set[int] = {0}  # containers of an h1 and main elements
        self.titles: set[int] = set()  # blocks that are an h1 or h2
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters in links
        self._read(source)
        self._settle()

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("", 0)]
        words: list[str] = []
        linked, in_link, in_title, at, end = 0, False, False, 0, len(source)

        def close_block() -> None:
            nonlocal linked
            if words:
                text = " ".join(html.unescape("".join(words)).split())
                if text:
                    if in_title:
                        self.titles.add(len(self.blocks))
                    self.blocks.append((stack[-1][1], text, linked))
                words.clear()
            linked = 0

        while at < end:
            m = _TOKEN.match(source, at)
            at = m.end()
            name = m.group(2)
            if name is None:
                piece = m.group()
                if piece[0] != "<" or len(piece) == 1:
                    words.append(piece)
                    if in_link:
                        linked += len(piece)
                continue
            name = name.lower()
            if name in RAW and not m.group(1):
                stop = re.compile(f"</{name}", re.I).search(source, at)
                at = stop.start() if stop else end
                continue
            if name in INLINE:
                if name == "a":
                    in_link = not m.group(1)
                continue
            close_block()
            in_title = not m.group(1) and name in ("h1", "h2")
            if name not in CONTAINERS:
                if name == "h1" and not m.group(1):
                    self.heads.add(stack[-1][1])
                continue
            if m.group(1):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
            elif not m.group(3).endswith("/"):
                stack.append((name, self._open(stack[-1][1], name, m.group(3))))
        close_block()

    def _open(self, parent: int, name: str, attributes: str) -> int:
        label, marked, seen = name, name == "form", set()
        for key, *values in _ATTR.findall(attributes):
            value, key = "".join(values), key.lower()
            if key in seen:  # the first of equal names holds
                continue
            seen.add(key)
            if key in ("class", "id", "role"):
                if key == "class" and value.split():
                    label = f"{name}.{_DIGITS.sub('#', value.split()[0].lower())}"
                marked = marked or any(map(_marks, value.split()))
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                marked = True
        self.tags.append(name)
        self.paths.append(f"{self.paths[parent]}/{label}")
        self.parent.append(parent)
        self.marked.append(marked and name not in ("html", "body"))
        self.never.append(self.never[parent] or (name in NEVER and name != "form"))
        if name == "main":
            self.heads.add(len(self.paths) - 1)
        return len(self.paths) - 1

    def _settle(self) -> None:
        """Which containers lie beside the article: marks of a container that is the page itself do not count."""
        n = len(self.paths)
        worth, paragraphs, heads = [0.0] * n, False, [box in self.heads for box in range(n)]
        for box, text, linked in self.blocks:
            if not self.never[box]:
                worth[box] += (value := _worth(text, linked))
                paragraphs = paragraphs or (len(text) >= 40 and value > 0)
        own = list(worth)
        for box in range(n - 1, 0, -1):
            worth[self.parent[box]] += worth[box]
            heads[self.parent[box]] = heads[self.parent[box]] or (heads[box] and not self.never[box])
        self.beside = [False] * n
        for box in range(1, n):
            page = worth[box] > (HALF if heads[box] else ALL) * worth[0]
            self.beside[box] = self.beside[self.parent[box]] or self.never[box] or (self.marked[box] and not page)
        left = sum(v for v, beside in zip(own, self.beside) if not beside)
        if paragraphs and left < (1 - ALL) * worth[0]:
            self.beside = list(self.never)

    def best(self) -> tuple[int, float]:
        """The container with the highest score (the first of equal ones), and the score."""
        score: dict[int, float] = defaultdict(float)
        for box, text, linked in self.blocks:
            if self.beside[box]:
                continue
            worth = _worth(text, linked)
            while box >= 0 and worth >= 1:
                score[box] += worth
                box, worth = self.parent[box], worth / 2
        return min(((box, v) for box, v in score.items()), key=lambda x: (-x[1], x[0]), default=(0, 0.0))

    def _inside(self, chosen: set[int]) -> list[bool]:
        inside = [False] * len(self.paths)
        for box, parent in enumerate(self.parent):
            inside[box] = box in chosen or (parent >= 0 and inside[parent])
        return inside

    def text(self, chosen: set[int]) -> str:
        """Blocks of the article around the chosen containers, without what lies beside it.

        All blocks below the chosen ones; and from above them, where it has paragraphs or titles and is not mostly
        links: an ancestor's own blocks, and those of whole branches that hold no chosen one.
        """
        inside = self._inside(chosen)
        above = {0} - chosen
        for box in chosen:
            while (box := self.parent[box]) >= 0:
                above.add(box)
        # The branch of a container outside: the ancestor whose own text it is, or its ancestor just below one.
        branch, length, linked = list(range(len(self.paths))), defaultdict(int), defaultdict(int)
        good, titled = set(), False
        sections = [False] * len(self.paths)
        for box, parent in enumerate(self.parent):
            if box not in above and parent >= 0 and parent not in above:
                branch[box] = branch[parent]
            sections[box] = self.tags[box] in ("article", "main", "section") or (parent >= 0 and sections[parent])
        for k, (box, text, links) in enumerate(self.blocks):
            if self.beside[box]:
                continue
            if k in self.titles and (inside[box] or self.tags[branch[box]] != "header"):
                titled = True
            if not inside[box]:
                length[branch[box]] += len(text)
                linked[branch[box]] += links
                if k in self.titles or (len(text) >= 40 and 3 * links <= len(text)):
                    good.add(branch[box])
        for box in list(good):
            banner = self.tags[box] == "header" and not sections[box] and titled
            if banner or 3 * linked[box] > length[box]:
                good.discard(box)
        return " ".join(t for box, t, _ in self.blocks
                        if not self.beside[box] and (inside[box] or branch[box] in good))

    def extract(self, paths: Container[str] | None) -> str:
        """The article's text by the paths of the page's host."""
        best, score = self.best()
        chosen = {box for box, p in enumerate(self.paths) if p in (paths or ()) and not self.beside[box]}
        if chosen:
            inside = self._inside(chosen)
            held = sum(_worth(t, n) for box, t, n in self.blocks if inside[box] and not self.beside[box])
            if 4 * held >= score and (text := self.text(chosen)):
                return text
        return self.text(chosen | {best})


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    votes: dict[tuple[str, str], float] = defaultdict(float)
    for batch in slices(batches, text_col="html"):
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(source)
            box, score = page.best()
            if score > 0:
                votes[host, page.paths[box]] += min(score, 5000.0)
        if len(votes) > 50_000:  # Spark adds the rest
            yield _ballot(votes)
            votes.clear()
    if votes:
        yield _ballot(votes)


def _ballot(votes: dict[tuple[str, str], float]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "host": pa.array([k[0] for k in votes], pa.string()), "path": pa.array([k[1] for k in votes], pa.string()),
        "votes": pa.array([round(v) for v in votes.values()], pa.int64())})


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text_col="html"):
        get = lambda c: batch.column(batch.schema.get_field_index(c))
        text = [Page(s).extract(p) for s, p in zip(get("html").to_pylist(), get("paths").to_pylist())]
        yield pa.RecordBatch.from_pydict({
            "page_id": get("page_id"), "url": get("url"), "text": pa.array(text, pa.string()),
            "n_chars": pa.array(map(len, text), pa.int64())})


def host_of(url: str) -> Column:
    """Between the first "://" and the next "/", "?", "#" or the end, A-Z lowered; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "^(?s:.*?)://([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def winning_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, paths): of each host the path with most votes, the first by name of equal ones, and all others with at
    least a ``SHARE``-th of its votes."""
    rows = pages.select(host_of(url_col).alias("host"), F.col(html_col).cast("string").alias("html"))
    votes = rows.mapInArrow(_vote, "host string, path string, votes long")
    total = stage(votes.groupBy("host", "path").agg(F.sum("votes").alias("votes")), "host-votes")
    hosts = total.groupBy(F.col("host").alias("of")).agg(
        F.sum("votes").alias("all_votes"), F.min_by("path", F.struct(-F.col("votes"), "path")).alias("first"))
    kept = total.join(hosts, F.col("host") == F.col("of")).where(
        (F.col("path") == F.col("first")) | (F.col("votes") * SHARE >= F.col("all_votes")))
    return kept.groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("paths"))  # at most SHARE + 1


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Null or empty pages, and pages without any text of their own, have an empty
    text.  Pages without a host vote together.  Repeated rows vote and come out as
    often as they are there.
    """
    paths = stage(winning_paths(pages, url_col, html_col), "host-paths")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"), host_of(url_col).alias("page_host"))
    joined = rows.join(paths, F.col("page_host") == F.col("host"), "left").select("page_id", "url", "html", "paths")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
