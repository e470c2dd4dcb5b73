"""Main text of pages by equivalence-class template deduction.

Tokens of a page are its tags and text nodes, told apart by the path of open
elements. Tokens of one host that occur equally often on the same pages share
an occurrence vector; the vector is kept as a sum of page hashes weighted by the
count, which tasks add up before anything is shuffled, so a host with any number
of pages costs one row per token and task. Tokens with equal vectors form a
class, provided they lie on half of the host's pages. A class is ordered when its
tokens follow each other in one order in every occurrence; tokens that do not are
taken out. An occurrence leaves a gap behind each token but its last. Two classes
nest when every occurrence of one lies in the same gap of the other, and are apart
when none lies in any; a class that does neither with a class before it (the class
of all pages first, then those with one occurrence a page) is not valid. The valid ones, each in its gap,
are the host's template.

Text of a valid class is part of the template (notices, labels, repeated lines).
The other text stands in slots, which are the gaps of the innermost class around
it, told apart by path. A slot inside navigation, headers, footers, sidebars,
forms, adverts, notices or reader comments is dropped by the role of the elements
around it: on a page, where they say so, and on all pages of the host, where nine
in ten of those with text in the slot say so. Of the rest, those inside the
article element are the main text where there is one.

Templates are deduced from the different pages of a host, told apart by their
tokens, and only where there are ``MIN_PAGES``, as copies of one article would look
alike. Null and empty pages, and pages without tokens, have an empty text and do
not count as pages of their host. Pages without a url share the host "". Repeated
pages are extracted alike.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

MIN_PAGES = 8
MIN_CLASS = 2
# A slot is dropped on all pages when this share of its pages has it inside boilerplate only.
SLOT_ROLE = 0.9

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title|textarea|svg|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?/][^>]*>|([^<]+|<)", re.DOTALL | re.IGNORECASE)
_MARKS = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_SELF_CLOSING = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

# Elements, and words in their class, id or role, that mark a slot as not the article.
_DROPPED = frozenset("head nav aside footer form button select menu dialog".split())
_ROLES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|comments?|replies|respond|disqus|sidebar|side|menu|nav|navbar|navigation|"
    r"breadcrumbs?|footer|share|sharing|social|related|recommended|newsletter|subscribe|signup|login|popup|modal|overlay|widget|pagination|complementary|contentinfo|search)(?:$|[\s_-])", re.IGNORECASE)


def parse(page: str) -> Iterator[tuple[str, str, bool, bool, bool]]:
    """(path, text, dropped, in article, ends block) of tags (empty text) and text nodes in page order."""
    names: list[str] = []
    flags: list[tuple[bool, bool]] = []

    def close(to: int) -> None:
        del names[to:], flags[to:]

    for m in _TOKEN.finditer(page):
        slash, tag, rest, text = m[2], m[3], m[4], m[5]
        if text is not None:
            dropped, article = flags[-1] if flags else (False, False)
            yield "/".join(names), text, dropped, article, False
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            if tag in names:
                at = len(names) - 1 - names[::-1].index(tag)
                block = any(n not in _INLINE for n in names[at:])
                close(at)
                yield "/".join((*names, "/" + tag)), "", False, False, block
            continue
        if tag in _ENDS_P and "p" in names:
            close(len(names) - 1 - names[::-1].index("p"))
        elif tag in _SELF_CLOSING and tag in names:
            at = len(names) - 1 - names[::-1].index(tag)
            if not _SELF_CLOSING[tag] & set(names[at + 1:]):
                close(at)
        dropped, article = flags[-1] if flags else (False, False)
        if tag not in ("html", "body", "article", "main"):
            marks = " ".join(a or b or c for a, b, c in _MARKS.findall(rest)) if rest else ""
            dropped = dropped or tag in _DROPPED or tag == "header" and not article or bool(marks and _ROLES.search(marks))
        article = article or tag in ("article", "main")
        yield "/".join((*names, tag)), "", dropped, article, tag not in _INLINE
        if tag not in _VOID and not rest.rstrip().endswith("/"):
            names.append(tag)
            flags.append((dropped, article))


def _squeeze(text: str) -> str:
    return " ".join(references.unescape(text).split())


def _token(path: str, text: str) -> int:
    """Signed 64-bit name of a token."""
    value = xxhash.xxh64_intdigest(f"{path}\n{text}".encode("utf-8", "replace"))
    return value - (1 << 64) if value >> 63 else value


def _place(path: str) -> int:
    """Signed 32-bit name of the path of a text node."""
    value = xxhash.xxh32_intdigest(path.encode("utf-8", "replace"))
    return value - (1 << 32) if value >> 31 else value


_TAG, _TEXT, _DROPPED_TEXT = range(3)


def sequence(page: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a page in its order, their kinds and the places of its text nodes (0 for tags)."""
    names, kinds, places = [], bytearray(), []
    tags: dict[str, int] = {}
    for path, text, dropped, *_ in parse(page):
        if not text:
            if (name := tags.get(path)) is None:
                name = tags[path] = _token(path, "")
            names.append(name)
            kinds.append(_TAG)
            places.append(0)
        elif squeezed := _squeeze(text):
            names.append(_token(path, squeezed))
            kinds.append(_DROPPED_TEXT if dropped else _TEXT)
            places.append(_place(path))
    return np.array(names, np.int64), np.frombuffer(bytes(kinds), np.uint8), np.array(places, np.int32)


class Template:
    """Valid classes of a host, as rows (tokens in order, parent, gap), the text among their tokens and dropped slots (class, gap, place)."""

    def __init__(self, classes=(), texts=(), slots=()):
        self.of = {t: (k, rank) for k, c in enumerate(classes) for rank, t in enumerate(c["tokens"])}
        self.last = [len(c["tokens"]) - 1 for c in classes]
        self.texts = frozenset(texts)
        self.slots = frozenset((s["class"], s["gap"], s["place"]) for s in slots)


class _Walk:
    """Innermost open class of a template and its gap, while the tokens of a page go by."""

    def __init__(self, template: Template):
        self.template, self.open = template, []

    def step(self, token: int) -> None:
        at = self.template.of.get(token)
        if at is None:
            return
        # occurrences inside of this one are over
        while any(k == at[0] for k, _ in self.open):
            if self.open.pop()[0] == at[0]:
                break
        if at[1] < self.template.last[at[0]]:
            self.open.append(at)

    def slot(self) -> tuple[int, int]:
        return self.open[-1] if self.open else (-1, 0)


def main_text(page: str, template: Template | None = None) -> str:
    """Blocks of the slots that belong to the article, joined by newlines."""
    blocks: list[tuple[str, bool]] = []
    parts: list[str] = []
    article_now = False
    walk = _Walk(template) if template and template.slots else None
    tags: dict[str, int] = {}

    def end() -> None:
        text = _squeeze("".join(parts))
        if text:
            blocks.append((text, article_now))
        parts.clear()

    for path, text, dropped, article, ends in parse(page):
        if ends:
            end()
        if not text:
            if walk:
                if (name := tags.get(path)) is None:
                    name = tags[path] = _token(path, "")
                walk.step(name)
            if path.endswith("/br") or path == "br":
                parts.append(" ")
            continue
        if template and (walk or not dropped) and (squeezed := _squeeze(text)):
            token = _token(path, squeezed)
            if token in template.texts:
                dropped = True
            elif walk and not dropped:
                dropped = (*walk.slot(), _place(path)) in template.slots
            if walk:
                walk.step(token)
        if dropped:
            continue
        if parts and article != article_now:
            end()
        article_now = article
        parts.append(text)
    end()
    inside = [text for text, article in blocks if article]
    return "\n".join(inside or [text for text, _ in blocks])


def _host():
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


_NESTED = ("ARRAY<STRUCT<is_root: BOOLEAN, once: BOOLEAN, pages: BIGINT, uses: BIGINT, size: INT, tokens: ARRAY<BIGINT>, texts: ARRAY<BIGINT>, "
           "parent: INT, gap: INT>>")


def _sequences(pages: DataFrame) -> DataFrame:
    """(host, digest, names, kinds, places) of the different pages of each host, as bytes of their arrays."""

    def run(batches):
        for batch in batches:
            rows = []
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                names, kinds, places = sequence(page or "")
                if len(names):
                    rows.append((host, xxhash.xxh3_128_digest(names.tobytes()), names.tobytes(), kinds.tobytes(), places.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.binary() if i else pa.string()) for i in range(5)],
                                             names=["host", "digest", "names", "kinds", "places"])

    rows = pages.select(_host().alias("host"), "html").mapInArrow(run, "host STRING, digest BINARY, names BINARY, kinds BINARY, places BINARY")
    # of pages with the same tokens, which may differ in attributes, the one whose roles come first
    least = F.min(F.struct("kinds", "names", "places")).alias("page")
    return rows.groupBy("host", "digest").agg(least).select("host", "digest", "page.*")


def _by_host(batch, column: str, cache: dict, make):
    """Index rows by host, with what ``make`` makes of the host's cell in ``column``."""
    found: dict[str, list[int]] = {}
    hosts = batch.column("host").to_pylist()
    for r, host in enumerate(hosts):
        found.setdefault(host, []).append(r)
    for host, rows in found.items():
        if host not in cache:
            if len(cache) >= 256:
                cache.clear()
            cache[host] = make(batch.column(column)[rows[0]].as_py())
        yield host, rows, cache[host]


def _names(batch, r: int) -> np.ndarray:
    return np.frombuffer(batch.column("names")[r].as_buffer(), np.int64)


class _Members:
    """Tokens of the classes of a host as sorted arrays: class and place in the class of each."""

    def __init__(self, classes):
        of = sorted((t, k, rank) for k, c in enumerate(classes) for rank, t in enumerate(c["tokens"]))
        self.token, self.cls, self.rank = (np.array([o[i] for o in of], np.int64) for i in range(3))
        self.size = np.array([len(c["tokens"]) for c in classes], np.int64)

    def on(self, names: np.ndarray):
        """Members on a page in its order, and how many tokens of each class come before each place (and behind the last)."""
        at = np.minimum(np.searchsorted(self.token, names), len(self.token) - 1)
        at = at[self.token[at] == names]
        before = np.zeros((len(at) + 1, len(self.size)), np.int64)
        before[np.arange(1, len(at) + 1), self.cls[at]] = 1
        return at, before.cumsum(axis=0)


def _host_classes(members: DataFrame) -> DataFrame:
    """(host, classes) of rows (host, vector, pages, uses, is_root, rank, token, is_text): root first, then those once a page, by pages; tokens by rank."""
    grouped = members.groupBy("host", "vector", "pages", "uses", "is_root").agg(F.array_sort(F.collect_list(F.struct("rank", "token", "is_text"))).alias("m"))
    grouped = grouped.where(F.size("m") >= MIN_CLASS)
    texts = F.transform(F.filter("m", lambda x: x["is_text"]), lambda x: x["token"])
    one = F.struct("is_root", (F.col("uses") == F.col("pages")).alias("once"), "pages", "uses", F.size("m").alias("size"), F.col("m.token").alias("tokens"), texts.alias("texts"))
    return grouped.groupBy("host").agg(F.reverse(F.array_sort(F.collect_list(one))).alias("classes"))


def _ordered(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """(host, token, rank) of the tokens whose place in the occurrences of their class is always the same."""

    def run(batches):
        cache: dict = {}
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for host, rows, m in _by_host(batch, "classes", cache, _Members):
                low, high = np.full(len(m.token), 1 << 40), np.full(len(m.token), -1)
                for r in rows:
                    at, before = m.on(_names(batch, r))
                    rank = before[np.arange(len(at)), m.cls[at]] % m.size[m.cls[at]]
                    np.minimum.at(low, at, rank)
                    np.maximum.at(high, at, rank)
                met = high >= 0
                for column, values in zip(out, ([host] * int(met.sum()), m.token[met].tolist(), low[met].tolist(), high[met].tolist())):
                    column += values
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if i else pa.string()) for i, v in enumerate(out)], names=["host", "token", "low", "high"])

    rows = pages.join(classes, "host").select("host", "names", "classes").mapInArrow(run, "host STRING, token LONG, low LONG, high LONG")
    ranks = rows.groupBy("host", "token").agg(F.min("low").alias("rank"), F.max("high").alias("high"))
    return ranks.where("rank = high").drop("high")


_OUTSIDE, _ACROSS = -1, -2  # besides the gap in which an occurrence lies


def _relations(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """(host, a, b, low, high): where occurrences of class a lie in those of b, the least and greatest of it."""

    def run(batches):
        cache: dict = {}
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for host, rows, m in _by_host(batch, "classes", cache, _Members):
                n = len(m.size)
                low, high = np.full((n, n), 1 << 40), np.full((n, n), -3)
                for r in rows:
                    at, before = m.on(_names(batch, r))
                    cls, rank = m.cls[at], m.rank[at]
                    first, last = np.flatnonzero(rank == 0), np.flatnonzero(rank == m.size[cls] - 1)
                    # by class; the occurrences of a class are in order
                    first, last = first[np.argsort(cls[first], kind="stable")], last[np.argsort(cls[last], kind="stable")]
                    if not len(first):
                        continue
                    i, j = before[first], before[last]
                    lies = np.where(i == j, i % m.size - 1, _ACROSS)
                    begin = np.flatnonzero(np.append(True, np.diff(cls[first]) != 0))
                    of = cls[first][begin]
                    low[of] = np.minimum(low[of], np.minimum.reduceat(lies, begin, axis=0))
                    high[of] = np.maximum(high[of], np.maximum.reduceat(lies, begin, axis=0))
                a, b = np.nonzero((high > -3) & ~np.eye(n, dtype=bool))
                for column, values in zip(out, ([host] * len(a), a.tolist(), b.tolist(), low[a, b].tolist(), high[a, b].tolist())):
                    column += values
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if i else pa.string()) for i, v in enumerate(out)], names=["host", "a", "b", "low", "high"])

    rows = pages.join(classes, "host").select("host", "names", "classes").mapInArrow(run, "host STRING, a LONG, b LONG, low LONG, high LONG")
    return rows.groupBy("host", "a", "b").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def nest(classes: list[dict], relations: list[dict]) -> list[dict]:
    """The valid classes, each with its parent (its index, -1 for none) and the gap of the parent that it lies in."""
    lies = {(r["a"], r["b"]): r["low"] for r in relations if r["low"] == r["high"] != _ACROSS}
    kept: list[int] = []
    for a in range(len(classes)):
        if all((a, b) in lies or (b, a) in lies for b in kept):
            kept.append(a)
    index = {a: k for k, a in enumerate(kept)}
    around = {a: [b for b in kept if lies.get((a, b), _OUTSIDE) >= 0] for a in kept}
    out = []
    for a in kept:
        # classes around one class lie in each other: the innermost has most around it
        parent = max(around[a], key=lambda b: len(around[b]), default=None)
        out.append({**classes[a], "parent": -1 if parent is None else index[parent], "gap": 0 if parent is None else lies[a, parent]})
    return out


def _nested(classes: DataFrame, relations: DataFrame) -> DataFrame:
    """(host, classes) with the valid classes of each host, nested."""

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            kind = pa.list_(pa.struct([("is_root", pa.bool_()), ("once", pa.bool_()), ("pages", pa.int64()), ("uses", pa.int64()), ("size", pa.int32()), ("tokens", pa.list_(pa.int64())),
                                       ("texts", pa.list_(pa.int64())), ("parent", pa.int32()), ("gap", pa.int32())]))
            yield pa.RecordBatch.from_arrays([pa.array([r["host"] for r in rows], pa.string()),
                                              pa.array([nest(r["classes"], r["relations"] or []) for r in rows], kind)], names=["host", "classes"])

    lists = relations.groupBy("host").agg(F.collect_list(F.struct("a", "b", "low", "high")).alias("relations"))
    return classes.join(lists, "host", "left").select("host", "classes", "relations").mapInArrow(run, f"host STRING, classes {_NESTED}")


def _dropped_slots(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """(host, slots): places in gaps whose text lies inside boilerplate on nearly all pages that have text there."""

    def run(batches):
        cache: dict = {}
        for batch in batches:
            seen: dict[tuple, list[int]] = {}
            for host, rows, template in _by_host(batch, "classes", cache, Template):
                for r in rows:
                    kinds, places = (np.frombuffer(batch.column(c)[r].as_buffer(), t).tolist() for c, t in (("kinds", np.uint8), ("places", np.int32)))
                    walk, own = _Walk(template), {}
                    for name, kind, place in zip(_names(batch, r).tolist(), kinds, places):
                        if name in template.of:
                            walk.step(name)
                        elif kind and walk.open:
                            slot = (host, *walk.slot(), place)
                            own[slot] = own.get(slot, True) and kind == _DROPPED_TEXT
                    for slot, dropped in own.items():
                        cell = seen.setdefault(slot, [0, 0])
                        cell[0] += 1
                        cell[1] += dropped
            keys = list(seen)
            yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32(), pa.int32()))),
                                              *(pa.array([seen[k][i] for k in keys], pa.int64()) for i in range(2))], names=["host", "class", "gap", "place", "n", "dropped"])

    rows = pages.join(classes, "host").select("host", "names", "kinds", "places", "classes")
    rows = rows.mapInArrow(run, "host STRING, class INT, gap INT, place INT, n LONG, dropped LONG")
    slots = rows.groupBy("host", "class", "gap", "place").agg(F.sum("n").alias("n"), F.sum("dropped").alias("dropped"))
    slots = slots.where((F.col("n") >= MIN_PAGES) & (F.col("dropped") < F.col("n")) & (F.col("dropped") >= F.col("n") * SLOT_ROLE))
    return slots.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("class", "gap", "place"))).alias("slots"))


def deduce_templates(pages: DataFrame) -> DataFrame:
    """(host, classes, text_tokens, slots): the valid equivalence classes of each host, root first, each with its tokens in
    order, its parent and the parent's gap; the text among their tokens; and the slots that are dropped on all pages."""

    def run(batches):
        for batch in batches:
            sums: dict[tuple[str, int], list] = {}
            for r, (host, digest) in enumerate(zip(batch.column("host").to_pylist(), batch.column("digest").to_pylist())):
                own = int.from_bytes(digest[:4], "little")
                tokens, first, counts = np.unique(_names(batch, r), return_index=True, return_counts=True)
                texts = np.frombuffer(batch.column("kinds")[r].as_buffer(), np.uint8)[first] != _TAG
                for token, count, is_text in zip(tokens.tolist(), counts.tolist(), texts.tolist()):
                    cell = sums.setdefault((host, token), [0, 0, 0, is_text])
                    cell[0] += own * count % 0x7FFFFFFF
                    cell[1] += 1
                    cell[2] += count
            rows = list(sums.items())
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int64()), *(
                pa.array([v[i] for _, v in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.bool_())))], names=["host", "token", "vector", "pages", "uses", "is_text"])

    # null and empty pages have no tokens and are no evidence against a class
    different = cut_lineage(_sequences(pages))
    hosts = different.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES)
    sums = different.select("host", "digest", "names", "kinds").mapInArrow(run, "host string, token long, vector long, pages long, uses long, is_text boolean")
    sums = sums.groupBy("host", "token").agg(*(F.sum(c).alias(c) for c in ("vector", "pages", "uses")), F.first("is_text").alias("is_text"))
    large = sums.join(hosts, "host").where(F.col("pages") * 2 >= F.col("n"))  # on at least half of the host's pages
    root = (F.col("pages") == F.col("n")) & (F.col("uses") == F.col("n"))
    members = cut_lineage(large.select("host", "vector", "pages", "uses", root.alias("is_root"), "token", "is_text"))
    ranks = _ordered(different, cut_lineage(_host_classes(members.withColumn("rank", F.lit(0).cast("long")))))
    ordered = cut_lineage(_host_classes(members.join(ranks, ["host", "token"])))
    nested = cut_lineage(_nested(ordered, _relations(different, ordered)))
    texts = F.flatten(F.transform("classes", lambda c: F.when(c["pages"] >= MIN_PAGES, c["texts"]).otherwise(F.array().cast("array<bigint>"))))
    return nested.join(_dropped_slots(different, nested), "host", "left").select("host", "classes", texts.alias("text_tokens"), "slots")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages (page_id, url, html)."""

    def run(batches):
        cache: dict = {}
        for batch in batches:
            texts = [""] * batch.num_rows
            html = batch.column("html")
            make = lambda t: t and Template(t["classes"] or (), t["text_tokens"], t["slots"] or ())
            for _, rows, template in _by_host(batch, "template", cache, make):
                for r in rows:
                    texts[r] = main_text(html[r].as_py() or "", template)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), "url", "html", _host().alias("host"))
    # written first: its size is known to the join, which need not move the pages of a large host to one task;
    # the nesting is only needed where a slot is dropped
    deciding = deduce_templates(pages).where((F.size("text_tokens") > 0) | F.col("slots").isNotNull())
    nesting = F.when(F.col("slots").isNotNull(), F.transform("classes", lambda c: F.struct(c["tokens"].alias("tokens"))))
    templates = cut_lineage(deciding.select("host", F.struct(nesting.alias("classes"), "text_tokens", "slots").alias("template")))
    joined = rows.join(templates, "host", "left")
    return joined.select("page_id", "url", "html", "host", "template").mapInArrow(run, "page_id long, url string, text string, n_chars long")
