"""Main text of web pages: a suffix array of each host's token streams, and element roles."""

from __future__ import annotations

import html
import re
from collections.abc import Collection, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import durable
from tidemark.llm.flat import mixed

# Element names of the HTML standard by their role here
_RAW = ("script", "style", "template", "noscript", "textarea", "title", "iframe", "svg", "math", "object")
_ASIDE = {
    "nav", "footer", "header", "aside", "form", "menu", "dialog", "button", "select", "head", "canvas", "audio", "video",
    *_RAW,
}
_MAIN = {"article", "main"}
# Elements of the HTML standard that hold a text rather than others
_TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "li", "dt", "dd", "td", "th", "figcaption", "caption"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
    "var", "wbr",
}
_CLOSED_BY = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Words in class, id or role that name parts which are no main text
_ROLE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|notice|notification|popup|modal|nav\w*|"
    r"menu|breadcrumbs?|side-?bar|footer|foot|header|masthead|comments?|replies|disqus|share|sharing|social|related|"
    r"newsletter|subscribe|login|signup|search|skip-?link|contentinfo|complementary|navigation)(?:$|[\s_-])"
)
_TAG_NAME = re.compile(r"(/?)([A-Za-z][^\s/>]*)")
_TAG_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")
# Bytes that tell runs of a host apart, and pages whose suffixes are put in order together
RUN_BYTES = 5
RANGE_PAGES = 2_000
# Stands for a host's number of pages among its runs, which are never negative
PAGES = -1


def attributes(tag: str) -> dict[str, str]:
    """Lower-cased names of a tag's attributes and their values, the first of equal names."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(tag):
        found.setdefault(name.lower(), value.strip("\"'"))
    return found


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, name, rest) of every tag in order; comments and declarations have an empty name.

    A tag ends at the first > outside a quoted value, and a value is quoted if the quote follows an equals sign. Everything
    is looked for from where the last search ended: once a quote stays open to the end of the page, quotes count no more,
    and once no > is left, no tag is. So the time grows with the page, whatever stands in it.
    """
    at, quoted = page.find("<"), True
    while at >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
            yield at, end, "", "", ""
            at = page.find("<", end)
            continue
        named = _TAG_NAME.match(page, at + 1)
        if named is None:
            end = page.find(">", at + 1) + 1 if page[at + 1 : at + 2] in ("!", "?") else -1
            if end == 0:
                return
            if end > 0:
                yield at, end, "", "", ""
            at = page.find("<", max(end, at + 1))
            continue
        end = named.end()
        while True:
            stop = _TAG_STOP.search(page, end)
            if stop is None:
                return
            end = stop.end()
            if stop[0] == ">":
                break
            before = stop.start() - 1
            while page[before].isspace():
                before -= 1
            if quoted and page[before] == "=":
                close = page.find(stop[0], end)
                if close < 0:
                    quoted, end = False, named.end()
                else:
                    end = close + 1
        yield at, end, named[1], named[2].lower(), page[named.end() : end - 1]
        at = page.find("<", end)


def is_aside(name: str, rest: str, in_main: bool) -> bool:
    """Whether an element is, by its name and attributes, a part that is no main text.

    Words of class, id and role speak for elements that hold others; paragraphs, headlines and the like inside the main
    element are text whatever they are called. An article is the main element unless one of its words as a whole names
    another part, as those of reader comments do.
    """
    marks = attributes(rest) if rest else {}
    if "hidden" in marks or marks.get("aria-hidden", "").lower() == "true" or _NO_DISPLAY.search(marks.get("style", "")):
        return True
    if name in _ASIDE:
        return not (in_main and name == "header")  # an article's own headline
    words = " ".join(marks.get(key, "") for key in ("class", "id", "role")).lower()
    if not words or name in ("body", "html") or in_main and name in _TEXT:
        return False
    if name in _MAIN:
        return any(_ROLE.fullmatch(word) for word in words.split())
    return bool(_ROLE.search(words))


def blocks(page: str) -> list[tuple[bool, str]]:
    """The page's text blocks in order, with whether they lie in the main element; parts named otherwise are left out.

    Left out are elements that are never main text (menus, headers, footers, asides, forms, scripts, styles), and
    elements whose class, id or role names such a part (``is_aside``). A block ends where a block-level element or a line
    break begins or ends. Elements that the page forgets to close end with the element around them.
    """
    found: list[tuple[bool, str]] = []
    open_names: list[str] = []
    open_count: dict[str, int] = {}
    dropped_at = main_at = 0  # depth (from 1) of the outermost dropped and main element
    words: list[str] = []

    def end_block() -> None:
        if words:
            text = _SPACE.sub(" ", html.unescape("".join(words))).strip()
            words.clear()
            if text:
                found.append((main_at > 0, text))

    def close(depth: int) -> None:
        nonlocal dropped_at, main_at
        for name in open_names[depth - 1 :]:
            open_count[name] -= 1
        del open_names[depth - 1 :]
        if dropped_at >= depth:
            dropped_at = 0
        if main_at >= depth:
            main_at = 0

    def last(name: str) -> int:
        """Depth of the innermost open element of that name; what is passed over is closed next."""
        depth = len(open_names)
        while open_names[depth - 1] != name:
            depth -= 1
        return depth

    at, raw = 0, ""  # end of the last tag, and the element whose content is no markup
    for start, end, slash, name, rest in tags(page):
        if raw:
            if not (slash and name == raw):
                continue
            at, raw = end, ""
            continue
        if start > at and not dropped_at:
            words.append(page[at:start])
        at = end
        if not name:
            continue
        if name not in _INLINE and not dropped_at:
            end_block()
        if slash:
            if open_count.get(name):
                close(last(name))
            continue
        if name in _VOID or rest.endswith("/") and name not in _RAW:
            continue
        if name in _RAW:
            raw = name
            continue
        if name in _CLOSED_BY and open_names and open_names[-1] in _CLOSED_BY[name]:
            close(len(open_names))
        elif name not in _INLINE and "p" in open_names[-3:]:
            close(last("p"))
        open_names.append(name)
        open_count[name] = open_count.get(name, 0) + 1
        depth = len(open_names)
        if not dropped_at:
            if is_aside(name, rest, main_at > 0):
                dropped_at = depth
            elif name in _MAIN and not main_at:
                main_at = depth
    if not raw and not dropped_at and at < len(page):
        words.append(page[at:])
    end_block()
    return found


def suffixes(texts: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the first ``length`` tokens of every suffix of the token stream, and the block each suffix starts in.

    The number is a hash of ``RUN_BYTES``. Runs are told apart within a host only, and only hosts of at most 30 pages ask
    for as few as three: 40 bits confuse two of their runs with a chance of about 1e-8.
    """
    words = [text.split() for text in texts]
    of = np.repeat(np.arange(len(texts)), [len(w) for w in words])
    tokens = pd.util.hash_array(np.array([w for block in words for w in block], dtype=object), categorize=True)
    keys = np.zeros(max(0, len(tokens) - length + 1), np.uint64)
    for i in range(length):
        keys = mixed(keys + tokens[i : i + len(keys)] + np.uint64(i))
    return (keys >> np.uint64(64 - 8 * RUN_BYTES)).view(np.int64), of


def host_of(url_column: str):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url_column), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def packed_runs(keys: np.ndarray) -> bytes:
    """Distinct run numbers in order, as differences, the bytes of equal weight next to each other: they compress well."""
    steps = np.diff(np.unique(keys), prepend=0).astype("<i8")
    return steps.view(np.uint8).reshape(-1, 8)[:, :RUN_BYTES].T.tobytes()


def unpacked_runs(packed: bytes) -> np.ndarray:
    """The run numbers of ``packed_runs``, in order."""
    planes = np.frombuffer(packed, np.uint8).reshape(RUN_BYTES, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :RUN_BYTES] = planes.T
    return np.cumsum(steps.view("<i8")[:, 0])


def repeated_runs(pages: DataFrame, length: int, least_pages: int, least_share: float) -> DataFrame:
    """host and the numbers of the runs of ``length`` tokens that many pages of the host hold, from all its pages.

    This is the part of a host's suffix array that matters for such runs: suffixes of all its pages, whatever their
    markup names, are brought into order by their first ``length`` tokens; suffixes that share them stand together, and
    their group gives the number of distinct pages. A run longer than ``length`` is the union of such groups. Each page
    counts once per run, however many rows it has. A page sends its suffixes in order, packed into a row, and a host of very
    many pages is put in order in several ranges, so no task holds a host.
    """

    def streams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for page_id, host, page, ranges in zip(batch["page_id"], batch["host"], batch["html"], batch["_ranges"], strict=True):
                keys = suffixes([text for _, text in blocks(page)], length)[0]
                if not len(keys):
                    continue
                home, part = page_id % ranges, keys % ranges  # the page itself is counted where its id belongs
                for i in np.union1d(np.unique(part), [home]):
                    out.append((page_id, host, i, packed_runs(keys[part == i]), i == home))
            if out:
                yield pd.DataFrame(out, columns=["page_id", "host", "part", "runs", "home"])

    def order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[str, list] = {"host": [], "run": [np.zeros(0, np.int64)], "_n": [np.zeros(0, np.int64)]}
            for host, ids, packed, homes in zip(*(batch[c] for c in ("host", "ids", "packed", "homes")), strict=True):
                by_page: dict[int, list[np.ndarray]] = {}
                for page_id, one in zip(ids, packed, strict=True):
                    by_page.setdefault(page_id, []).append(unpacked_runs(one))
                ordered = np.concatenate([p[0] if len(p) == 1 else np.unique(np.concatenate(p)) for p in by_page.values()])
                runs, counts = np.unique(ordered, return_counts=True)
                shared = counts >= least_pages
                found["host"].extend([host] * (1 + int(shared.sum())))
                found["run"] += [[PAGES], runs[shared]]
                found["_n"] += [[len(set(homes))], counts[shared]]
            if found["host"]:
                yield pd.DataFrame({"host": found["host"], "run": np.concatenate(found["run"]), "_n": np.concatenate(found["_n"])})

    asked = pages.filter(F.col("page_id").isNotNull()).select("page_id", host_of("url").alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    # At most a row for each RANGE_PAGES pages of the table
    large = asked.groupBy("host").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > RANGE_PAGES)
    ranges = F.coalesce(F.ceil(F.col("_rows") / RANGE_PAGES), F.lit(1)).cast("long").alias("_ranges")
    ready = asked.join(F.broadcast(large), "host", "left").select("page_id", "host", "html", ranges)
    sent = ready.mapInPandas(streams, "page_id long, host string, part long, runs binary, home boolean")
    together = sent.groupBy("host", "part").agg(
        F.collect_list("page_id").alias("ids"),
        F.collect_list("runs").alias("packed"),
        F.collect_list(F.when(F.col("home"), F.col("page_id"))).alias("homes"),
    )
    counted = durable(together.mapInPandas(order, "host string, run long, _n long"))
    sizes = counted.filter(F.col("run") == PAGES).groupBy("host").agg(F.sum("_n").alias("_pages"))
    shared = counted.filter(F.col("run") != PAGES).join(sizes, "host").filter(F.col("_n") >= F.col("_pages") * least_share)
    return shared.groupBy("host").agg(F.collect_list("run").alias("_runs"))


def main_text(page: str, runs: Collection[int], length: int, covered: float) -> str:
    """The page's main text: its main element, or else the blocks that repeated runs do not cover."""
    found = blocks(page)
    chosen = [text for main, text in found if main]
    if not chosen:
        chosen = [text for _, text in found]
        if len(runs) and chosen:
            keys, of = suffixes(chosen, length)
            hit = np.zeros(len(of) + 1, int)
            for at in np.flatnonzero(np.isin(keys, list(runs))):
                hit[at] += 1
                hit[at + length] -= 1
            inside = np.cumsum(hit)[:-1] > 0
            share = np.bincount(of, inside, len(chosen)) / np.maximum(np.bincount(of, minlength=len(chosen)), 1)
            chosen = [text for text, part in zip(chosen, share, strict=True) if part < covered]
    return "\n".join(chosen)


def extract_pages(
    pages: DataFrame, length: int = 8, least_pages: int = 3, least_share: float = 0.1, covered: float = 0.8
) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    The suffix array of a host is built of all its pages. A block of which at least ``covered`` of the tokens lie in runs of
    ``length`` or more tokens, each found on at least ``least_pages`` and ``least_share`` of the host's pages, is boilerplate
    unless it lies in the element that the page names as its main part (``blocks``): articles quote each other. On pages that
    name one, nothing else is text. Unique runs stay.

    A null html is an empty page with the empty text; null ids and urls stay null; repeated rows are extracted each;
    pages are read whole, whatever their length. An empty table gives an empty result.
    """
    runs = durable(repeated_runs(pages, length, least_pages, least_share))
    wide = pages.select(F.col("page_id").cast("string").alias("_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host_of("url").alias("host"))
    ready = wide.join(runs, (wide["host"] == runs["host"]) & wide["_id"].isNotNull(), "left").select("_id", "url", "html", "_runs")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = [() if r is None else r for r in batch["_runs"]]
            text = [main_text(page, r, length, covered) for page, r in zip(batch["html"], known, strict=True)]
            yield pd.DataFrame({"_id": batch["_id"], "url": batch["url"], "text": text})

    done = ready.mapInPandas(run, "_id string, url string, text string")
    return done.select(F.col("_id").cast("long").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))
