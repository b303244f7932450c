"""HTML extraction by wrapper induction.

Pages of one host are made by one wrapper.  Each page's tree of block elements
is aligned with that of the host's model page by simple tree matching.  A node
that says the same on nearly all aligned pages belongs to the template, where a
page says just that; what varies fills a slot of the wrapper, and slots are content unless the element
is one of the parts of a page that are never its article (see ``DROPPED`` and
``DROPPED_NAMES``).  Where a page marks its article, slots outside it are
dropped too.  What is or holds the article is never dropped by its name or as a
form: see ``Page.settle``.  Inside a marked article only the names of
``NEVER_NAMES`` drop an element; another such name does where half of its
letters are links.

The model page is the one of least page-id hash.  Of pages of equal html one
counts, as copies alone make nothing template.  Nodes are counted by (host,
node, text) with partial sums, so a host of any number of pages is a few rows;
pages themselves only meet their model page.

Null html counts as empty and gives an empty text; a null or odd url belongs to
the host "".  A host of fewer than ``FEWEST_PAGES`` different pages has no
template: what its pages say is told by the kinds of elements alone.  Elements
may be nested to any depth, and a page is read in time that grows with its
length: a "<" that no ">" follows is text, and where quotes in tags never end,
the page's tags end at the next ">".  Repeated rows are extracted each.  An
empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import clean_columns, slices, stored

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg canvas object audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var ruby rb rt rp "
        "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mspace mstyle mpadded menclose semantics annotation".split()
)
DROPPED = frozenset("head nav header footer aside button select dialog menu".split())
FORMS = frozenset("form fieldset".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
KEEPERS = frozenset("html body article main section div table ul ol dl nav header footer aside form blockquote".split())
DROPPED_NAMES = frozenset(
    (
        "ad ads adv advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup "
        "modal overlay sidebar side aside rail menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments reply replies "
        "respond discussion disqus share sharing social related recommended recommendations newsletter subscribe subscription widget pagination pager login signup "
        "signin register search toolbar skip hidden copyright legal disclaimer tags"
    ).split()
)
#: Of those the names that say what even a marked article holds and is no part of it: adverts, consent, comments, forms for readers, sidebars, buttons.
NEVER_NAMES = frozenset(
    (
        "ad ads adv advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr comment comments disqus newsletter "
        "subscribe subscription login signup signin register share sharing social sidebar nav navbar navigation breadcrumb breadcrumbs toolbar pagination pager"
    ).split()
)
#: The share of letters in links from which a part of another such name is a menu.
MENU_LINKS = 0.5
#: Words beside those of ``DROPPED_NAMES`` in the name of such a part.
PART_WORDS = frozenset(
    "area bar block bottom box btn button buttons container content count form global group icons inner item items left link links list main message outer panel "
    "primary right row secondary section site text title top wrap wrapper".split()
)
#: Pages a node must be aligned on, and the share of equal texts, to be template.
MOST_SAME, FEWEST_PAGES = 0.8, 8
#: Above this many pairs of children, a row of pairs is worked out at once.
FEW_PAIRS = 200
SLICE = 1 << 20

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
#: A whole tag, past quoted values.
TAG = re.compile(NAME.pattern + r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
#: How many times its length a page is read in vain for the ends of quotes.
QUOTE_READS = 8
NAMES = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW_END = {t: re.compile(rf"</{t}\s*>", re.IGNORECASE) for t in RAW}

PAGE = "page_id long, url string, text string, n_chars long"


def part_name(token: str) -> bool:
    """Is a whole class, id or role the name of a part that is never the article?"""
    pieces = {p.lower() for p in PIECES.findall(token)}
    return bool(pieces & DROPPED_NAMES) and pieces <= DROPPED_NAMES | PART_WORDS


def telling(token: str) -> bool:
    """Does the name hold for parts of a marked article too?"""
    return part_name(token) and bool({p.lower() for p in PIECES.findall(token)} & NEVER_NAMES)


@lru_cache(maxsize=4096)
def described(tag: str, attributes: str) -> tuple[str, int, int, bool]:
    """Label for alignment; never content by its kind 2, by its name or as a form 1; surely the article 2, maybe 1; whether an article may hold it unless it is links."""
    found = [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in NAMES.finditer(attributes)] if attributes else []
    classes = " ".join(sorted(w for k, v in found if k != "id" for w in v.split()))
    named = tag not in ("html", "body") and any(part_name(w) for _, v in found for w in v.split())
    sure = tag == "main" or any(k == "role" and v.lower() == "main" for k, v in found)
    maybe = tag == "article" or any(k in ("role", "itemprop") and v.lower() in ("main", "articlebody") for k, v in found)
    drop = 2 if tag in DROPPED else int(named or tag in FORMS)
    told = tag in FORMS or tag in DROPPED and tag != "dialog" or any(telling(w) for _, v in found for w in v.split())
    return f"{tag}.{classes}", drop, 2 if sure else int(maybe), drop > 0 and not told


class Page:
    """Block elements as parallel lists, and the blocks of text in page order."""

    def __init__(self, source: str):
        self.label, self.parent, self.children, self.drop, self.mark, self.header = ["root"], [-1], [[]], [0], [0], [False]
        self.soft, linked, in_link = [False], [], 0
        self.blocks: list[tuple[int, str]] = []
        stack, tags = [0], ["root"]
        parts: list[str] = []
        at, end = 0, len(source)

        def flush() -> None:
            nonlocal in_link
            if parts:
                text = " ".join(entities.unescape("".join(parts)).split())
                if text:
                    self.blocks.append((stack[-1], text))
                    linked.append(in_link)
                parts.clear()
            in_link = 0

        last, vain = source.rfind(">"), 0
        anchor: int | None = None
        opened = Counter(tags)

        def close(k: int) -> None:
            opened.subtract(tags[k:])
            del tags[k:], stack[k:]

        while at < end:
            stop = source.find("<", at)
            if stop < 0 or stop > last and not source.startswith("<!--", stop):
                # Behind the last ">" no tag can end.
                parts.append(source[at:])
                break
            if stop > at:
                parts.append(source[at:stop])
            m = TAG.match(source, stop) if vain <= QUOTE_READS * end else None
            if m:
                at, attributes = m.end(), m[3]
            elif source.startswith("<!--", stop):
                at = source.find("-->", stop + 4)
                at = at + 3 if at >= 0 else end
                continue
            elif source[stop + 1 : stop + 2] in ("!", "?"):
                at = source.find(">", stop) + 1
                continue
            elif m := NAME.match(source, stop):
                # Quotes that don't end: the tag ends at the next ">".
                vain += end - m.end()
                at = source.find(">", m.end()) + 1
                attributes = source[m.end() : at - 1]
            else:
                parts.append("<")
                at = stop + 1
                continue
            tag, closing = m[2].lower(), bool(m[1])
            if tag == "a" and closing and anchor is not None:
                in_link += sum(map(len, parts[anchor:]))
            if tag == "a":
                anchor = None if closing else len(parts)
            if tag in INLINE:
                continue
            anchor = None if tag not in ("br", "img") else anchor
            if tag == "br" or tag == "img":
                parts.append(" ")
                continue
            if tag in RAW:
                if not closing:
                    rest = RAW_END[tag].search(source, at)
                    at = rest.end() if rest else end
                continue
            flush()
            if tag in VOID:
                continue
            if closing:
                for k in range(len(tags) - 1, 0, -1) if opened[tag] else ():
                    if tags[k] == tag:
                        close(k)
                        break
                    if tags[k] in KEEPERS and tag not in KEEPERS:
                        break
                continue
            if tags[-1] == "p":
                close(len(tags) - 1)
            if tag in CLOSES and any(opened[t] for t in CLOSES[tag]):
                for k in range(len(tags) - 1, 0, -1):
                    if tags[k] in CLOSES[tag]:
                        close(k)
                        break
                    if tags[k] in ("ul", "ol", "dl", "table", "select"):
                        break
            label, drop, mark, soft = described(tag, attributes)
            over = stack[-1]
            node = len(self.label)
            self.label.append(label)
            self.parent.append(over)
            self.children.append([])
            self.children[over].append(node)
            self.drop.append(drop)
            self.mark.append(mark)
            self.soft.append(soft)
            self.header.append(tag == "header")
            stack.append(node)
            tags.append(tag)
            opened[tag] += 1
        flush()
        if any(self.soft):
            letters, links = [0] * len(self.label), [0] * len(self.label)
            for (n, text), k in zip(self.blocks, linked, strict=True):
                letters[n] += len(text)
                links[n] += k
            for n in range(len(self.label) - 1, 0, -1):
                letters[self.parent[n]] += letters[n]
                links[self.parent[n]] += links[n]
            self.soft = [s and links[n] < MENU_LINKS * letters[n] for n, s in enumerate(self.soft)]
        self.dropped, self.main = self.settle()

    def flags(self, exempt: set[int]) -> tuple[list[bool], list[bool]]:
        """dropped, inside the marked article, of each node."""
        dropped, main = [False], [False]
        for n in range(1, len(self.label)):
            over = self.parent[n]
            # A header inside is the heading of the article itself, and most names say little there.
            inside = main[over] and not dropped[over]
            own = bool(self.drop[n]) and n not in exempt and not ((self.header[n] or self.soft[n]) and inside)
            dropped.append(own or dropped[over])
            main.append((self.mark[n] > 0 and not own) or main[over])
        return dropped, main

    def settle(self) -> tuple[list[bool], list[bool]]:
        """``flags``, but what is or holds the article isn't dropped by name or as a form.

        The article is what is surely marked so; else the ``article`` of most
        text if it holds as much as would be left without it (a comment or
        teaser does not); on a page without marks, what holds over half of the
        text outside the elements whose kind is never content.
        """
        exempt: set[int] = set()

        def free(n: int) -> None:
            while n > 0 and n not in exempt:
                if self.drop[n] == 1:
                    exempt.add(n)
                n = self.parent[n]

        for n, mark in enumerate(self.mark):
            if mark == 2:
                free(n)
        dropped, main = self.flags(exempt)
        if not any(d == 1 and n not in exempt for n, d in enumerate(self.drop)):
            return dropped, main
        never, within, total = [False], [0] * len(self.label), 0
        for n in range(1, len(self.label)):
            never.append(self.drop[n] == 2 or never[self.parent[n]])
        marked = any(main[n] and not dropped[n] for n, _ in self.blocks)
        left = sum(len(t) for n, t in self.blocks if not dropped[n] and (main[n] or not marked))
        for n, text in self.blocks:
            if not never[n]:
                within[n] += len(text)
                total += len(text)
        for n in range(len(self.label) - 1, 0, -1):
            within[self.parent[n]] += within[n]
        articles = [n for n, mark in enumerate(self.mark) if mark]
        most = max(articles, key=within.__getitem__, default=0)
        if most and dropped[most] and within[most] and within[most] >= left:
            free(most)
        elif not marked and not articles:
            for n, d in enumerate(self.drop):
                if d == 1 and 2 * within[n] > total:
                    free(n)
        return self.flags(exempt)

    def shape(self) -> str:
        return " ".join(f"{p}{x}" for p, x in zip(self.parent, self.label, strict=True))


def best_pairs(weight: list[dict[int, int]], xs: list[int], ys: list[int]) -> tuple[int, list[tuple[int, int]]]:
    """Weight and pairs (i, j), both rising, of greatest weight; ``weight[xs[i]]`` has the pairs of ``xs[i]``.

    Long lists need memory for their lengths times the root of a length only:
    every so many rows one is kept, and the rows between are made again on the
    way back.
    """
    n, m = len(xs), len(ys)
    if n * m <= FEW_PAIRS:
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i, x in enumerate(xs):
            for j, y in enumerate(ys):
                here = max(best[i][j + 1], best[i + 1][j])
                if y in weight[x]:
                    here = max(here, best[i][j] + weight[x][y])
                best[i + 1][j + 1] = here
        row = lambda i: best[i]
        total = best[n][m]
    else:
        columns, widest = np.array(ys), max(ys) + 1

        def following(above: np.ndarray, x: int) -> np.ndarray:
            out = above.copy()
            w = np.zeros(widest, np.int64)
            w[list(weight[x])] = list(weight[x].values())
            w = w[columns]
            np.maximum(out[1:], np.where(w > 0, above[:-1] + w, 0), out=out[1:])
            return np.maximum.accumulate(out)

        step = max(1, int(n**0.5))
        now, kept = np.zeros(m + 1, np.int64), {0: np.zeros(m + 1, np.int64)}
        for i, x in enumerate(xs):
            now = following(now, x)
            if (i + 1) % step == 0:
                kept[i + 1] = now
        total = int(now[m])
        made: dict[int, np.ndarray] = {}

        def row(i: int) -> np.ndarray:
            if i not in made:
                made.clear()
                first = max(0, i - 1) // step * step
                made[first] = kept[first]
                for k in range(first, i):
                    made[k + 1] = following(made[k], xs[k])
            return made[i]

    i, j, pairs = n, m, []
    while i and j:
        here = row(i)
        # Rows i and i - 1 are made together, or i - 1 was kept.
        above = row(i - 1)
        if here[j] == above[j]:
            i -= 1
        elif here[j] == here[j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return total, pairs


def align(model: Page, page: Page) -> dict[int, int]:
    """Nodes of ``page`` and the model's nodes they match, by simple tree matching.

    Equal subtrees have one number, and each pair of numbers is matched once,
    lower trees first, without recursion.
    """
    numbers: dict[tuple, int] = {}
    label: list[str] = []
    below: list[tuple[int, ...]] = []
    size: list[int] = []
    height: list[int] = []

    def numbered(tree: Page) -> list[int]:
        own = [0] * len(tree.label)
        for n in range(len(own) - 1, -1, -1):
            children = tuple(own[c] for c in tree.children[n])
            k = own[n] = numbers.setdefault((tree.label[n], children), len(label))
            if k == len(label):
                label.append(tree.label[n])
                below.append(children)
                size.append(1 + sum(size[c] for c in children))
                height.append(1 + max((height[c] for c in children), default=0))
        return own

    of_model, of_page = numbered(model), numbered(page)
    found: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def easy(a: int, b: int) -> int:
        """Size of the matching where no work is needed, or 0."""
        return size[a] if a == b else 1 if not below[a] or not below[b] else 0

    wanted, left = set(), [(of_model[0], of_page[0])]
    while left:
        pair = left.pop()
        if pair in wanted or easy(*pair):
            continue
        wanted.add(pair)
        by_label: dict[str, list[int]] = {}
        for y in set(below[pair[1]]):
            by_label.setdefault(label[y], []).append(y)
        left += [(x, y) for x in set(below[pair[0]]) for y in by_label.get(label[x], ())]
    for a, b in sorted(wanted, key=lambda p: height[p[0]]):
        xs, ys = below[a], below[b]
        lo = hi = 0
        # Equal leaves at either end match each other.
        while lo < min(len(xs), len(ys)) and xs[lo] == ys[lo] and not below[xs[lo]]:
            lo += 1
        while hi < min(len(xs), len(ys)) - lo and xs[-1 - hi] == ys[-1 - hi] and not below[xs[-1 - hi]]:
            hi += 1
        ends = [(k, k) for k in range(lo)] + [(len(xs) - 1 - k, len(ys) - 1 - k) for k in range(hi)]
        xs, ys = xs[lo : len(xs) - hi], ys[lo : len(ys) - hi]
        kinds_x, kinds_y = {x: k for k, x in enumerate(dict.fromkeys(xs))}, {y: k for k, y in enumerate(dict.fromkeys(ys))}
        by_label = {}
        for y in kinds_y:
            by_label.setdefault(label[y], []).append(y)
        weight = [{kinds_y[y]: easy(x, y) or found[x, y][0] for y in by_label.get(label[x], ())} for x in kinds_x]
        total, pairs = best_pairs(weight, [kinds_x[x] for x in xs], [kinds_y[y] for y in ys])
        found[a, b] = 1 + len(ends) + total, ends + [(i + lo, j + lo) for i, j in pairs]

    matched, left = {}, [(0, 0)]
    while left:
        x, y = left.pop()
        matched[y] = x
        a, b = of_model[x], of_page[y]
        if a == b:
            left += zip(model.children[x], page.children[y], strict=True)
        elif (a, b) in found:
            left += [(model.children[x][i], page.children[y][j]) for i, j in found[a, b][1]]
    return matched


@lru_cache(maxsize=64)
def model_page(source: str) -> Page:
    return Page(source)


_aligned: dict[tuple[int, str], dict[int, int]] = {}


def aligned(model: Page, page: Page) -> dict[int, int]:
    """``align``, remembered for pages of the same shape."""
    key = (id(model), page.shape())
    if key not in _aligned:
        if len(_aligned) > 2000:
            _aligned.clear()
        # The model itself is kept, so its id stays its own.
        _aligned[key] = (model, align(model, page))
    return _aligned[key][1]


def said(page: Page) -> dict[int, int]:
    """Hash of what each node with text says by itself."""
    own: dict[int, list[str]] = {}
    for n, text in page.blocks:
        own.setdefault(n, []).append(text)
    return {n: hash_text("\n".join(t)) for n, t in own.items()}


def main_text(page: Page, template: dict[int, int], nodes: dict[int, int]) -> str:
    """The page's text without what it drops and the nodes that say their template's text."""
    constant = {n for n, text in said(page).items() if n in nodes and template.get(nodes[n]) == text} if template else ()
    marked = any(page.main[n] and not page.dropped[n] for n, _ in page.blocks)
    keep = [t for n, t in page.blocks if not page.dropped[n] and (page.main[n] or not marked) and n not in constant]
    return "\n".join(keep)


def host(url) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/?#:]*)", 1)), F.lit(""))


def with_model(pages: DataFrame) -> DataFrame:
    """host, model: the html of the page of least page-id hash, found by ids alone."""
    some = pages.filter("length(html) > 0").select("host", "page_id", "html", F.xxhash64("page_id").alias("h"))
    least = some.groupBy("host").agg(F.min(F.struct("h", "page_id")).alias("least")).select("host", "least.*")
    # Written first, so that its size decides whether it is broadcast; beyond that the join deals pages by id, not by host.
    least = stored(least.select(F.col("host").alias("least_host"), F.col("h").alias("least_h"), F.col("page_id").alias("least_id")), "wrapper-least")
    # Rows of one page id may differ: the least text of them is the model.
    same = F.col("page_id").eqNullSafe(F.col("least_id"))
    chosen = some.join(least, (F.col("host") == F.col("least_host")) & (F.col("h") == F.col("least_h")) & same)
    return stored(chosen.groupBy("host").agg(F.min("html").alias("model")), "wrapper-models")


def templates(pages: DataFrame, models: DataFrame) -> DataFrame:
    """host, model, template, constants: the model's constant nodes and the hashes of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html", SLICE):
                node, texts = [], []
                for source, model in zip(part.column("html").to_pylist(), part.column("model").to_pylist(), strict=True):
                    page = Page(source)
                    nodes = aligned(model_page(model), page)
                    own = {nodes[n]: text for n, text in said(page).items() if n in nodes}
                    node.append(list(own))
                    texts.append(list(own.values()))
                yield pa.record_batch([part.column("host"), part.column("content"), pa.array(node, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.int64()))], names=["host", "content", "node", "said"])

    rows = pages.filter("length(html) > 0").join(models, "host").select("host", F.xxhash64("html").alias("content"), "html", "model")
    rows = rows.mapInArrow(run, "host string, content long, node array<int>, said array<long>")
    once = rows.groupBy("host", "content").agg(F.first(F.arrays_zip("node", "said")).alias("own"))
    nodes = once.select("host", F.explode("own").alias("own")).select("host", "own.node", "own.said").groupBy("host", "node", "said").agg(F.count("*").alias("n"))
    nodes = nodes.groupBy("host", "node").agg(F.sum("n").alias("n"), F.max(F.struct("n", "said")).alias("most"))
    constant = nodes.filter((F.col("n") >= FEWEST_PAGES) & (F.col("most.n") >= MOST_SAME * F.col("n")))
    constant = constant.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("node", "most.said"))).alias("c")).select("host", F.col("c.node").alias("template"), F.col("c.said").alias("constants"))
    return stored(models.join(constant, "host", "left"), "wrapper-templates")


def hash_text(text: str) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(text)).astype(np.int64))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    pages = clean_columns(pages, "page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("long")).withColumn("host", host(F.col("url")))
    wrappers = templates(pages, with_model(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html", SLICE):
                texts = []
                for source, model, template, constants in zip(*(part.column(c).to_pylist() for c in ("html", "model", "template", "constants")), strict=True):
                    page = Page(source or "")
                    nodes = aligned(model_page(model), page) if template else {}
                    texts.append(main_text(page, dict(zip(template or (), constants or (), strict=True)), nodes))
                yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.join(wrappers, "host", "left").select("page_id", "url", "html", "model", "template", "constants").mapInArrow(run, PAGE)
