"""Main text of HTML pages: structure first, then repeated runs by suffix arrays of each host's pages.

A page is parsed into blocks. Menus, headers, footers, sidebars, adverts, forms and the like are marked by their elements,
roles and class names and go. Blocks inside an article (or, without one, the main element) are vouched for; a page
without either has open blocks.

Pages of a host are dealt into shards by a hash, and the token streams of a shard are concatenated, with an end mark for each page. Prefix doubling ranks all suffixes by their first ``RUN`` tokens: the suffix array
cut at that depth, in which suffixes of equal rank stand side by side. Copies, which are pages with equal blocks, are one stream,
so no copy takes away another's text. A run that a share of the host's distinct contents hold is repeated. Where a host has several shards, each content counts in the shard of one of its
pages; a run that reaches the share in the host reaches it in a shard, so the runs that do are counted in all shards, and their sums are exact. Open blocks lose their repeated runs and keep the unique ones (all of the block, if half of it or more is unique). A block that is vouched for goes only if
all of it is repeated on nearly every page: a passage that some pages share is text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import filled, lower_ascii, stored

RUN = 8  # tokens of the shortest repeated run, a power of two
SHARD_PAGES, SHARD_BYTES = 200, 4_000_000
LEAST_PAGES = 40  # of a shard on average, however long they are: in smaller ones any run reaches the share
FEW_CONTENTS = 20  # distinct contents to a shard of a host, on average; below it every run is counted at once
BROADCAST_HOSTS = 100_000  # names and numbers: some ten MB
OPEN_SHARE, OPEN_PAGES = 0.1, 3  # share and least number of distinct contents that make a run of open blocks boilerplate
VOUCHED_SHARE, VOUCHED_PAGES = 0.9, 50  # and of vouched blocks

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden|itemprop)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/]|$))""", re.I)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

DROPPED = set("nav aside footer form button select dialog menu label input".split())
UNREAD = set("script style noscript template textarea iframe svg math object canvas head title option audio video".split())
BLOCKS = set(
    "p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre section article main header footer nav aside table thead tbody tfoot tr caption figure figcaption address"
    " details summary hr form fieldset body html".split()
)
SPACED = set("br td th".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CHROME = set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidenav footer masthead banner ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored sponsors"
    " promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations"
    " comment comments commentlist respond disqus replies widget toolbar pagination pager paywall skip".split()
)
CHROME_ROLES = set("navigation banner contentinfo complementary search alert dialog alertdialog menu menubar toolbar form".split())


def _marks(attributes: str) -> tuple[bool, bool]:
    """Whether an element's attributes say that it is page furniture; that it is the main part."""
    furniture = main = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            furniture = furniture or any(part.lower() in CHROME for part in _NAME_PART.findall(value))
        elif name == "role":
            furniture, main = furniture or value.lower() in CHROME_ROLES, main or value.lower() in ("main", "article")
        elif name == "itemprop":
            main = main or value.lower() == "articlebody"
        elif name == "hidden":
            furniture = True
        elif name == "aria-hidden":
            furniture = furniture or value.lower() == "true"
        elif name == "style":
            furniture = furniture or re.search(r"display\s*:\s*none", value, re.I) is not None
    return furniture, main


def blocks(page: str | None) -> tuple[list[str], bool]:
    """The texts of a page's blocks in order, and whether an article or main element vouches for them."""
    page = page or ""
    found: list[list[str]] = [[], [], []]  # by level: anywhere, main, article
    stack: list[tuple[str, bool, int, bool]] = []  # name, dropped, level, in an article's header
    buffer: list[str] = []
    dropped, level, heading_only = False, 0, False

    def flush() -> None:
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            if text:
                found[level].append(text)
            buffer.clear()

    def state() -> tuple[bool, int, bool]:
        return (stack[-1][1], stack[-1][2], stack[-1][3]) if stack else (False, 0, False)

    def close(name: str, within: set[str]) -> None:
        """Pop up to the nearest open ``name``, if no element of ``within`` stands between."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    at, end = 0, len(page)
    while at < end:
        tag = _TAG.search(page, at)
        if tag is None or tag.start() > at:
            stop = tag.start() if tag else end
            if not dropped and (not heading_only or any(s[0] in HEADINGS for s in stack)):
                buffer.append(page[at:stop])
        if tag is None:
            break
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        closing, attributes = (tag[1] or tag[4]) == "/", tag[3] if tag[2] else tag[6] or ""
        if name in BLOCKS:
            flush()
        elif name in SPACED:
            buffer.append(" ")
        if closing:
            close(name, set() if name in BLOCKS else {"article", "main", "body"})
        elif name in UNREAD:
            if not attributes.endswith("/"):
                shut = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = shut.end() if shut else (at if name in ("head", "title", "option") else end)
            continue
        else:
            if name in BLOCKS and name not in ("html", "body"):
                close("p", BLOCKS - {"p"})
            if name in ("li", "tr", "dt", "dd", "td", "th"):
                close(name, {"ul", "ol", "table", "dl"})
            if name in VOID or attributes.endswith("/"):
                continue
            furniture, main = _marks(attributes) if attributes and name not in ("html", "body") else (False, False)
            was_dropped, was_level, was_heading = state()
            now_level = max(was_level, 2 if name == "article" or (main and name != "main") else 1 if name == "main" or main else 0)
            in_header = was_heading or (name == "header" and was_level > 0)
            stack.append((name, was_dropped or furniture or name in DROPPED or (name == "header" and was_level == 0), now_level, in_header))
        dropped, level, heading_only = state()
    flush()
    for wanted in (2, 1):
        if found[wanted]:
            return found[wanted], True
    return found[0], False


def _laid(streams: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All tokens one after another: codes, vocabulary, stream, place in it, and tokens to its end."""
    sizes = np.array([len(s) for s in streams])
    codes, vocabulary = pd.factorize(np.array([t for s in streams for t in s], dtype=object))
    place = np.concatenate([np.arange(n) for n in sizes])
    return codes, vocabulary, np.repeat(np.arange(len(streams)), sizes), place, np.repeat(sizes, sizes) - place


def _covered(counts: np.ndarray, place: np.ndarray, run: int) -> np.ndarray:
    """For each token the largest count of the runs that begin up to run - 1 before it in its stream."""
    covered = counts.copy()
    for k in range(1, run):
        moved = np.zeros_like(counts)
        moved[k:] = counts[:-k]
        moved[place < k] = 0
        covered = np.maximum(covered, moved)
    return covered


def _run_counts(codes: np.ndarray, owner: np.ndarray, left: np.ndarray, run: int) -> np.ndarray:
    """For each token the number of distinct streams that hold the run which begins there (0: none of ``run`` tokens).

    All suffixes are ranked by prefix doubling up to their first ``run`` tokens.
    """
    rank, width = codes.astype(np.int64), 1
    while width < run:
        after = np.full(len(rank), -1, dtype=np.int64)
        after[:-width] = rank[width:]
        after[left <= width] = -1  # a suffix ends with its page
        _, rank = np.unique(rank * (rank.max() + 2) + after + 1, return_inverse=True)
        width *= 2
    whole = np.flatnonzero(left >= run)
    # The truncated suffix array: equal prefixes are neighbours, within them the pages in order.
    order = whole[np.lexsort((owner[whole], rank[whole]))]
    r, o = rank[order], owner[order]
    new_rank = np.r_[True, r[1:] != r[:-1]] if len(r) else np.zeros(0, dtype=bool)
    pages_of = np.bincount(np.cumsum(new_rank) - 1, weights=new_rank | np.r_[True, o[1:] != o[:-1]]) if len(r) else np.zeros(0)
    counts = np.zeros(len(rank), dtype=np.int64)
    if len(r):
        counts[order] = pages_of[np.cumsum(new_rank) - 1].astype(np.int64)
    return counts


def repeated(streams: list[list[str]], run: int = RUN) -> list[np.ndarray]:
    """For each token of each stream, the number of distinct streams that hold the most common run covering it (0: none of ``run`` tokens)."""
    sizes = np.array([len(s) for s in streams])
    if not sizes.sum():
        return [np.zeros(n, dtype=np.int64) for n in sizes]
    codes, _, owner, place, left = _laid(streams)
    return np.split(_covered(_run_counts(codes, owner, left, run), place, run), np.cumsum(sizes)[:-1])


def _tokens(page) -> list[str]:
    return [w for b in page for w in (*b.split(" "), "\n")]  # block ends are tokens, so runs may span short blocks


def _limits(contents: int) -> tuple[int, int]:
    """The least numbers of a host's distinct contents that make a run of open and of vouched blocks boilerplate."""
    return max(OPEN_PAGES, int(np.ceil(OPEN_SHARE * contents))), max(VOUCHED_PAGES, int(np.ceil(VOUCHED_SHARE * contents)))


def _without(page, cover: np.ndarray, safe: bool, some: int, most: int) -> str:
    """The page's text without the boilerplate."""
    kept, at = [], 0
    for block in page:
        words = block.split(" ")
        here = cover[at : at + len(words)]
        at += len(words) + 1
        if safe:
            if here.min() < most:
                kept.append(block)
        else:
            left = [w for w, n in zip(words, here) if n < some]
            if left:  # a block that is mostly unique stays whole
                kept.append(block if 2 * len(left) >= len(words) else " ".join(left))
    return "\n".join(kept)


def unique_text(pages: list[list[str]], vouched: list[bool]) -> list[str]:
    """The text of each page of a host: its blocks without what is boilerplate among the distinct contents."""
    contents = list(dict.fromkeys(map(tuple, pages)))
    covers = dict(zip(contents, repeated([_tokens(page) for page in contents])))
    some, most = _limits(len(contents))
    return [_without(page, covers[tuple(page)], safe, some, most) for page, safe in zip(pages, vouched)]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row.

    Null or empty html: empty text. Null url: the empty host. Repeated rows are pages of their own id: a run on rows of one
    page_id counts once. Nothing is cut; a page longer than a shard is a shard's only oversized member. An empty table gives no rows.
    """
    rows = pages.select("page_id", "url", "html").withColumn("host", lower_ascii(F.regexp_extract(filled("url"), r"://([^/?#]*)", 1)))
    sizes = rows.groupBy("host").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length("html")).alias("_b"))
    by_bytes = F.least(F.ceil(F.coalesce("_b", F.lit(0)) / SHARD_BYTES), F.ceil(F.col("_n") / LEAST_PAGES))
    shards = sizes.select(F.col("host").alias("_h"), F.greatest(F.ceil(F.col("_n") / SHARD_PAGES), by_bytes).cast("long").alias("shards")).where(F.col("shards") > 1)
    shards = stored(shards, "host-shards")  # the hosts of more than one shard
    several = shards.count()
    shards = F.broadcast(shards) if several <= BROADCAST_HOSTS else shards
    parsed = rows.select("page_id", "url", "host", "html").mapInArrow(_parse, "page_id long, url string, host string, blocks array<string>, vouched boolean")
    dealt = parsed.join(shards, F.col("host") == F.col("_h"), "left").withColumn("shard", F.pmod(F.xxhash64("page_id"), F.coalesce("shards", F.lit(1)))).withColumn("content", F.xxhash64("blocks")).drop("_h")
    groups = dealt.drop("shards").repartition("host", "shard").groupBy("host", "shard")  # else a join by host would leave a host in one task
    if not several:
        return groups.applyInPandas(_shard, RESULT)
    # Contents as keys alone: a page counts by one of its contents (rows of a page_id may differ), a content in the shard of one of its pages.
    keys = dealt.where(F.col("shards") > 1).select("host", "shards", "shard", "page_id", "content").distinct()
    keys = stored(keys.withColumn("one", F.min("content").over(Window.partitionBy("host", "shard", "page_id"))), "host-contents")
    homes = keys.where(F.col("content") == F.col("one")).groupBy("host", "shards", "content").agg(F.min("shard").alias("shard"), F.count(F.lit(1)).alias("n"))
    hosts = homes.groupBy("host", "shards").agg(F.count(F.lit(1)).alias("total"))
    odd = keys.withColumn("odd", F.max((F.col("content") != F.col("one")).cast("int")).over(Window.partitionBy("host", "shard", "page_id"))).where("odd = 1")
    odd = odd.select("host", "shard", "content").distinct().join(homes.select("host", "content", "n"), ["host", "content"], "left")  # contents of such pages, and of how many pages each is the one
    hosts = F.broadcast(hosts) if several <= BROADCAST_HOSTS else hosts

    def everywhere(rows: DataFrame) -> DataFrame:
        """The rows for each shard of their host."""
        return rows.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))

    def small(*parts: DataFrame):
        """Rows for the shards: a content, a run or the host's number of contents each; no nulls, which would make doubles of them."""
        names = ("content", "run", "total", "shards", "n")
        alike = [p.select("host", "shard", *[(F.coalesce(c, F.lit(0)) if c in p.columns else F.lit(0)).cast("long").alias(c) for c in names], *[F.lit(c in p.columns).alias(f"is_{c}") for c in names[:2]]) for p in parts]
        return reduce(DataFrame.unionByName, alike).groupBy("host", "shard")

    homes = homes.drop("n", "shards")
    found = groups.cogroup(small(homes, everywhere(hosts))).applyInPandas(_local_runs, "host string, run long")
    wanted = found.distinct().join(hosts.select("host", "shards"), "host")
    counted = groups.cogroup(small(homes, everywhere(hosts), everywhere(wanted))).applyInPandas(_count_runs, "host string, run long, n long")
    counts = counted.groupBy("host", "run").agg(F.sum("n").alias("n")).join(hosts, "host")
    common = counts.where(F.col("n") >= F.greatest(F.lit(OPEN_PAGES), F.ceil(F.lit(OPEN_SHARE) * (F.col("total") - 1))) - 1).select("host", "shards", "run", "n")
    return groups.cogroup(small(everywhere(hosts), odd, everywhere(common))).applyInPandas(_cut, RESULT)


RESULT = "page_id long, url string, text string, n_chars long"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            some = batch.slice(i, 256)
            found = [blocks(h) for h in some.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [some.column("page_id"), some.column("url"), some.column("host"), pa.array([b for b, _ in found], pa.list_(pa.string())), pa.array([v for _, v in found], pa.bool_())],
                names=["page_id", "url", "host", "blocks", "vouched"],
            )


def _hashes(codes: np.ndarray, vocabulary: np.ndarray, left: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the run that begins at each token (0: none of ``RUN`` tokens), the same in every shard."""
    tokens = pd.util.hash_array(np.asarray(vocabulary, dtype=object), categorize=False)[codes]
    out = np.zeros(len(codes), dtype=np.uint64)
    for k in range(RUN):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out[: max(len(out) - k, 0)] += tokens[k:]  # fewer tokens than a run hold none
    out[left < RUN] = 0
    return out.view(np.int64)


def _home_streams(pages: pd.DataFrame, rows: pd.DataFrame) -> list[list[str]]:
    """The contents that count in this shard."""
    here = pages[pages["content"].isin(rows["content"][rows["is_content"]])].drop_duplicates("content")
    return [_tokens(b) for b in here["blocks"] if len(b)]


def _few(rows: pd.DataFrame) -> bool:
    return rows["total"].max() < FEW_CONTENTS * rows["shards"].max()


def _local_runs(key: tuple, pages: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """The runs that reach the share in this shard; none for a host of few contents."""
    streams = _home_streams(pages, rows) if len(pages) and len(rows) and not _few(rows) else []
    if not streams:
        return pd.DataFrame({"host": pd.Series([], dtype=object), "run": pd.Series([], dtype="int64")})
    n_here, total = int(rows["is_content"].sum()), int(rows["total"].max())
    codes, vocabulary, owner, _, left = _laid(streams)
    # One less of one content less, as a page of differing rows may count by another of them.
    least = max(1, -(-(_limits(total - 1)[0] - 1) * n_here // total))
    runs = _hashes(codes, vocabulary, left)[_run_counts(codes, owner, left, RUN) >= least]
    return pd.DataFrame({"host": key[0], "run": np.unique(runs)})


def _count_runs(key: tuple, pages: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """How many of this shard's contents hold each wanted run; in a host of few contents each run."""
    wanted, few = rows["run"][rows["is_run"]].to_numpy(), len(rows) > 0 and _few(rows)
    streams = _home_streams(pages, rows) if len(pages) and (few or len(wanted)) else []
    if not streams:
        return pd.DataFrame({"host": pd.Series([], dtype=object), "run": pd.Series([], dtype="int64"), "n": pd.Series([], dtype="int64")})
    codes, vocabulary, owner, _, left = _laid(streams)
    runs = _hashes(codes, vocabulary, left)
    here = left >= RUN if few else (left >= RUN) & np.isin(runs, wanted)
    pairs = pd.DataFrame({"owner": owner[here], "run": runs[here]}).drop_duplicates()
    counts = pairs["run"].value_counts()
    return pd.DataFrame({"host": key[0], "run": counts.index.to_numpy(dtype="int64"), "n": counts.to_numpy(dtype="int64")})


def _cut(pages: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """The text of each row by the host's counts of runs; hosts of one shard are counted here."""
    if rows.empty or pages.empty:
        return _shard(pages)
    pages, total = pages.reset_index(drop=True), int(rows["total"].max())
    common = rows[rows["is_run"]].sort_values("run")
    runs, numbers = common["run"].to_numpy(), common["n"].to_numpy()
    odd = rows[rows["is_content"]]
    pages_of = dict(zip(odd["content"], odd["n"]))
    one = pages.groupby("page_id", dropna=False)["content"].transform("min")
    distinct = pages.drop_duplicates("content")
    laid = {c: _laid([_tokens(b)]) for c, b in zip(distinct["content"], distinct["blocks"]) if len(b)}
    hashes = {c: _hashes(codes, vocabulary, left) for c, (codes, vocabulary, _, _, left) in laid.items()}
    done: dict[tuple, str] = {}
    texts = []
    for content, its, safe, b in zip(pages["content"], one, pages["vouched"], pages["blocks"]):
        if not len(b):
            texts.append("")
            continue
        if (content, its, safe) not in done:
            (_, _, _, place, left), here = laid[content], hashes[content]
            at = np.minimum(np.searchsorted(runs, here), max(len(runs) - 1, 0))
            counts = np.where((runs[at] == here) & (left >= RUN), numbers[at], 0) if len(runs) else np.zeros(len(here), dtype=np.int64)
            contents = total
            if content != its:  # this row stands for its page: its content comes in, and the page's own goes unless others have it
                comes, goes = not pages_of[content], pages_of[its] == 1
                contents += comes - goes
                counts = np.where(left >= RUN, counts + comes - (goes & np.isin(here, hashes.get(its, []))), 0)
            done[content, its, safe] = _without(b, _covered(counts, place, RUN), safe, *_limits(contents))
        texts.append(done[content, its, safe])
    return pd.DataFrame({"page_id": pages["page_id"], "url": pages["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def _shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.reset_index(drop=True)
    first = pdf.drop_duplicates("page_id") if pdf["page_id"].duplicated().any() else pdf
    if len(first) == len(pdf):
        texts = unique_text([list(b) for b in pdf["blocks"]], pdf["vouched"].tolist())
    else:  # rows of one page are one stream of the shard; each is cut by what other pages repeat
        once = dict(zip(first.index, unique_text([list(b) for b in first["blocks"]], first["vouched"].tolist())))
        by_content = {(pdf.at[i, "page_id"], tuple(pdf.at[i, "blocks"])): t for i, t in once.items()}
        texts = []
        for i, b in enumerate(pdf["blocks"]):
            key = (pdf.at[i, "page_id"], tuple(b))
            if key not in by_content:
                others = first[first["page_id"] != key[0]]
                by_content[key] = unique_text([list(b), *map(list, others["blocks"])], [pdf.at[i, "vouched"], *others["vouched"]])[0]
            texts.append(by_content[key])
    return pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})
