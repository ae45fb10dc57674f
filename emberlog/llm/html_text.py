"""Main text of HTML pages by tree scoring.

A page is read once into a tree. Elements that never hold the article by their kind (menus, footers, sidebars, form
controls, scripts, styles, hidden parts, the page's header) are left out as they open; a form is left out when it holds
neither an article nor most of the text. What remains is scored, by one rule for all pages:

* A block of text is worth a point, and more for its length and its commas, less for the share of it that is links. Words of a
  class or id that speak of adverts, comments, notices and the like lower the worth of all that is inside, and no more than that.
* A block passes its points to its container and, in decreasing parts, to the ancestors beyond; a container's points are
  discounted by its link density. From the best container on, the lowest ancestor with ``NEARLY`` all worth of the page is taken.
* Siblings of that container and of its ancestors, up to an ``article`` or ``main``, stay when they are parts of the same
  kind, when they are worth about as much a block as the container is, or when they are headings of what follows; those named
  as foreign do not.
* Inside, parts named as foreign go when their lowered worth a block is far below that of the rest. Lists of links go only where they
  stand before or after all other text, and so do boxes of a few words where no ``article`` or ``main`` bounds the text.

Character references are decoded, white space inside a block becomes one space, blocks are joined by a line feed.
A null or empty page, and one without text, gives an empty text. Broken markup is closed as browsers do in the simple
cases: a block ends an open paragraph, an unknown end tag is ignored, an unclosed comment or script goes to the end; quotes
count in attribute values only, and no longer once a tag was found not to end; a last tag without an end is text.
Repeated rows are treated each. Time and memory are in proportion to a page's length, whatever its markup is.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The possessive parts never try a second reading, so a tag costs its length.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
UNQUOTED_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
OPENING = re.compile(r"<(?=[a-zA-Z!?]|/[a-zA-Z])")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
WORD = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {
    name: re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE | re.ASCII)
    for name in "script style textarea title noscript iframe xmp noembed noframes".split()
}
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody"
    " td tfoot th thead tr ul".split()
)
#: What an opening tag closes when it is still open, up to the element that bounds the search.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
NEVER = frozenset(
    "nav footer aside script style noscript iframe button select textarea template svg object canvas audio video"
    " dialog title head menu input fieldset datalist".split()
)
KEPT = frozenset("html body main article".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of a class or id by what they leave of the worth; of several the strongest counts.
NAMED = (
    (
        1e-6,  # counts only where nothing else does
        frozenset(
            "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos cookie cookies consent"
            " gdpr newsletter subscribe subscription comment comments commentlist disqus breadcrumb breadcrumbs pagination pager paywall"
            " nav navbar navigation menu sidebar footer masthead banner widget toolbar topbar".split()
        ),
    ),
    (
        0.3,
        frozenset(
            "promotion notice notices notification alert signup login reply replies respond discussion share sharing social related"
            " recommended recommendations popup modal overlay header aside".split()
        ),
    ),
)
#: Words that speak for an element; beside them a weak word counts nothing and a strong one as a weak one.
CONTENT = frozenset("article content entry main post story text body".split())
#: What may stand in a head; anything else ends it.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol div section table dl".split())
BOXES = LISTS | {"center", "address", "form"}
BOUNDS = frozenset(("article", "main"))
PARTS = frozenset(("article", "section"))
REACH = 5
#: Texts from this length on are worth a point of their own.
SENTENCE = 25
#: The share of all worth that the container must hold.
NEARLY = 0.75
#: Worth a block, in parts of the container's, that siblings must have, and that parts named as foreign must have.
SIBLING, FOREIGN = 0.5, 0.2


class Tree:
    """The elements of a page in order of their opening, as parallel lists, and its blocks of text."""

    def __init__(self, page: str):
        self.tag, self.parent, self.dropped, self.last = ["#"], [-1], [False], [0]
        self.own, self.linked, self.links = [0], [0], [0]
        self.kind, self.factor, self.weight = [""], [1.0], [1.0]
        #: (innermost block element, text, share of it that is links)
        self.blocks: list[tuple[int, str, float]] = []
        self._read(page)

    def _read(self, page: str) -> None:
        stack, piece = [0], []
        open_at: dict[str, list[int]] = {}  # the places in the stack of the open elements of a name
        block_at = [0]  # those of the block elements
        inside_link = in_links = 0
        at = 0
        tags = TAG
        tag, parent, dropped, own, linked = self.tag, self.parent, self.dropped, self.own, self.linked

        def text(start: int, end: int) -> None:
            nonlocal in_links
            if start < end and tag[stack[-1]] == "head" and page[start:end].strip():
                close(len(stack) - 1)
            if start < end and not dropped[stack[-1]]:
                found = page[start:end]
                found = html.unescape(found) if "&" in found else found
                piece.append(found)
                if inside_link:
                    in_links += len(found)

        def flush() -> None:
            nonlocal in_links
            if piece:
                block = " ".join("".join(piece).split())
                piece.clear()
                if block:
                    owner = stack[block_at[-1]]
                    own[owner] += len(block)
                    linked[owner] += min(in_links, len(block))
                    self.blocks.append((owner, block, min(1.0, in_links / len(block))))
            in_links = 0

        def close(depth: int) -> None:
            nonlocal inside_link
            flush()
            for node in reversed(stack[depth:]):
                self.last[node] = len(tag) - 1
                inside_link -= tag[node] == "a"
                open_at[tag[node]].pop()
            del stack[depth:]
            while block_at[-1] >= depth:
                block_at.pop()

        def innermost(names: Iterable[str]) -> int:
            return max((open_at[name][-1] for name in names if open_at.get(name)), default=0)

        while (opening := OPENING.search(page, at)) is not None:
            start = opening.start()
            if page[start + 1] in "!?":
                text(at, start)
                comment = page.startswith("<!--", start)
                end = page.find("-->", start + 4) if comment else page.find(">", start)
                at = len(page) if end < 0 else end + (3 if comment else 1)
                continue
            found = tags.match(page, start)
            if found is None and tags is TAG:
                tags = UNQUOTED_TAG
                found = tags.match(page, start)
            if found is None:  # no tag ends behind this place
                break
            text(at, start)
            at = found.end()
            name = found[2].lower()
            if found[1]:
                depth = innermost((name,))
                if name == "p" and not depth:
                    flush()
                # The end of a formatting element leaves blocks open that were opened inside it.
                if depth and (name in BLOCKS or name in NEVER):
                    close(depth)
                elif depth > block_at[-1]:
                    inside_link = self._end_inline(stack, open_at, depth, inside_link)
                continue
            if tag[stack[-1]] == "head" and name not in HEAD:
                close(len(stack) - 1)
            if name in ("head", "html") and name in open_at:
                continue
            if name in RAW:
                ending = RAW[name].search(page, at)
                closing = -1 if ending is None else page.find(">", ending.end())
                at = len(page) if closing < 0 else closing + 1
                continue
            if name == "br":
                if not dropped[stack[-1]]:
                    piece.append(" ")
                continue
            if name in BLOCKS:
                if tag[stack[block_at[-1]]] == "p":
                    close(block_at[-1])
                if name in ENDS:
                    ended, bound = ENDS[name]
                    depth = innermost(ended)
                    if depth > innermost(bound):
                        close(depth)
                flush()
            if name in VOID:
                continue
            above = stack[-1]
            node = len(tag)
            values = self._attributes(found[3])
            inside = any(open_at.get(bound) for bound in BOUNDS)
            factor = self._named(name, values)
            tag.append(name)
            parent.append(above)
            dropped.append(dropped[above] or self._never(name, values, inside))
            self.last.append(node)
            own.append(0)
            linked.append(0)
            self.links.append(0)
            self.kind.append(values.get("class", ""))
            self.factor.append(factor)
            self.weight.append(self.weight[above] * factor)
            open_at.setdefault(name, []).append(len(stack))
            if name in BLOCKS:
                block_at.append(len(stack))
            elif name == "a":
                inside_link += 1
                self.links[stack[block_at[-1]]] += 1
            stack.append(node)
        text(at, len(page))
        close(1)
        flush()
        self.last[0] = len(tag) - 1

    def _end_inline(self, stack: list[int], open_at: dict[str, list[int]], depth: int, inside_link: int) -> int:
        """End formatting elements without ending the block of text they stand in; how many links are open then."""
        for node in reversed(stack[depth:]):
            self.last[node] = len(self.tag) - 1
            inside_link -= self.tag[node] == "a"
            open_at[self.tag[node]].pop()
        del stack[depth:]
        return inside_link

    @staticmethod
    def _attributes(attributes: str) -> dict[str, str]:
        if "=" not in attributes and "hidden" not in attributes:
            return {}
        return {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)}

    @staticmethod
    def _never(name: str, values: dict[str, str], inside: bool) -> bool:
        """Whether an element is left out by its kind, whatever it holds."""
        if name in NEVER or name == "header" and not inside:
            return True
        if name in ("html", "body"):
            return False
        if (
            "hidden" in values
            or values.get("aria-hidden") == "true"
            or "display:none" in values.get("style", "").replace(" ", "").lower()
        ):
            return True
        return name not in KEPT and values.get("role", "").lower() in ROLES

    @staticmethod
    def _named(name: str, values: dict[str, str]) -> float:
        """What the words of its class and id leave of an element's worth."""
        if not values or name in ("html", "body"):
            return 1.0
        named = set(WORD.findall((values.get("class", "") + " " + values.get("id", "")).lower()))
        levels = [left for left, words in NAMED if named & words] + [1.0]
        return levels[0] if not named & CONTENT else NAMED[1][0] if levels[0] < NAMED[1][0] else 1.0

    def _drop_forms(self) -> None:
        """Leave out the forms that hold neither an article nor most of the page's text."""
        forms = [k for k, name in enumerate(self.tag) if name == "form" and not self.dropped[k]]
        if not forms:
            return
        sums = list(accumulate(self.own, initial=0))
        articles = list(accumulate((x == "article" and not y for x, y in zip(self.tag, self.dropped, strict=True)), initial=0))
        gone = set()
        for node in forms:
            end = self.last[node] + 1
            if articles[end] == articles[node] and 2 * (sums[end] - sums[node]) <= sums[-1]:
                gone.add(node)
        cut = self._covered(gone)
        self.blocks = [block for block in self.blocks if not cut[block[0]]]
        for node in range(len(self.tag)):
            if cut[node]:
                self.own[node] = self.linked[node] = self.links[node] = 0

    def _summed(self, values: list[float]) -> list[float]:
        """For each element, the sum over it and all that is inside it."""
        total = values[:]
        for node in range(len(total) - 1, 0, -1):
            total[self.parent[node]] += total[node]
        return total

    def text(self) -> str:
        self._drop_forms()
        if not self.blocks:
            return ""
        n, tag, parent = len(self.tag), self.tag, self.parent
        points, worth, plain, blocks, headings = [0.0] * n, [0.0] * n, [0.0] * n, [0] * n, [0] * n
        values = [(len(block) >= SENTENCE) + block.count(",") + min(len(block) / 100, 3) for _, block, _ in self.blocks]
        for (node, _, share), value in zip(self.blocks, values, strict=True):
            worth[node] += value * (1 - share) * self.weight[node]
            plain[node] += value * (1 - share)
            blocks[node] += 1
            headings[node] += tag[node] in HEADINGS
            # A paragraph's own element is no container.
            container = parent[node] if tag[node] in ("p", "pre", "td", "li", "blockquote", *HEADINGS) else node
            for level in range(REACH):
                if container < 0:
                    break
                points[container] += value * self.weight[node] / (1 if level == 0 else 2 if level == 1 else 3 * level)
                container = parent[container]
        total, linked, links = self._summed(self.own), self._summed(self.linked), self._summed(self.links)
        worth, plain, blocks, headings = map(self._summed, (worth, plain, blocks, headings))
        density = [min(1.0, linked[k] / total[k]) if total[k] else 0.0 for k in range(n)]
        best = max(range(n), key=lambda k: (points[k] * (1 - density[k]), -k))
        while best > 0 and worth[best] < NEARLY * worth[0]:
            best = parent[best]
        rate = [worth[k] / blocks[k] if blocks[k] else 0.0 for k in range(n)]

        children: list[list[int]] = [[] for _ in range(n)]
        for node in range(1, n):
            if blocks[node]:
                children[parent[node]].append(node)
        kept = {best}
        node = best
        while node > 0:
            below, node = node, parent[node]
            follows = False
            for child in reversed(children[node]):
                if child == below:
                    follows = True
                    continue
                alike = tag[child] == tag[below] and (tag[child] in PARTS or self.kind[child] and self.kind[child] == self.kind[below])
                good = density[child] < 0.5 and self.factor[child] == 1 and (alike or rate[child] >= SIBLING * rate[best])
                follows = good or follows and headings[child] == blocks[child] and self.factor[child] == 1
                if follows:
                    kept.add(child)
            if tag[below] in BOUNDS:
                break
        chosen = self._covered(kept)

        # What is foreign by name is measured against the blocks beside it that are not.
        unnamed = [
            value * (1 - share)
            for (node, _, share), value in zip(self.blocks, values, strict=True)
            if chosen[node] and self.weight[node] == self.weight[best]
        ]
        usual = sum(unnamed) / len(unnamed) if unnamed else 0.0
        cut = {
            k for k in range(1, n)
            if self.factor[k] < 1 and chosen[k] and blocks[k]
            and not (k <= best <= self.last[k]) and rate[k] / self.weight[best] < FOREIGN * usual
        }
        gone = self._covered(cut)
        # At the ends, what is mostly links or, where nothing bounds the text, a box of a few words.
        bounded = self._covered({k for k in range(n) if tag[k] in BOUNDS})
        lists = self._covered({k for k in range(n) if tag[k] in LISTS and density[k] > 0.5 and links[k] >= 3})
        boxes = self._covered(
            {c for c in children[best] if tag[c] in BOXES and not bounded[c] and plain[c] < 1 and not headings[c]}
        )
        held = [(node, block) for node, block, _ in self.blocks if chosen[node] and not gone[node]]
        solid = [
            k for k, (node, _) in enumerate(held)
            if not boxes[node] and (not lists[node] or 2 * self.linked[node] <= self.own[node])
        ]
        if solid:
            held = held[solid[0] : solid[-1] + 1]
        return "\n".join(block for _, block in held)

    def _covered(self, roots: set[int]) -> list[int]:
        """For each element, how many of ``roots`` hold it."""
        steps = [0] * (len(self.tag) + 1)
        for node in roots:
            steps[node] += 1
            steps[self.last[node] + 1] -= 1
        return list(accumulate(steps))


def main_text(page: str | None) -> str:
    return Tree(page).text() if page else ""


def html_text(df: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of each row, the main text of its page and the text's code points (text, n_chars)."""
    kinds = [df.schema[name].dataType.simpleString() for name in keep]

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(0).to_pylist()]
            columns = [*batch.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [f"c{k}" for k in range(len(columns))])

    chosen = df.select(F.col(html_col).alias("page"), *(F.col(name).alias(f"c{k}") for k, name in enumerate(keep)))
    fields = [f"c{k} {kind}" for k, kind in enumerate([*kinds, "string", "bigint"])]
    return chosen.mapInArrow(extract, ", ".join(fields)).toDF(*keep, "text", "n_chars")
