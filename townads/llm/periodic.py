"""Periodic runs of words: stretches that repeat one passage several times in a row.

A text is read word by word into a suffix automaton. Its link tree is a link-cut tree whose preferred
paths hold the classes of substrings that were last seen at the same place: reading word ``i`` accesses
the class of the text so far, which recolours the path up to the root with ``i``. Every path segment
met on the way gives the place ``e`` where its substrings ended last and the length of the longest one;
if that length reaches the distance ``i - e``, the text ends in a square of that period there, and it
reaches back by the segment's length. A square that the next word does not go on with closes a run.

Before that, a text is cut: of a run's words all triples but those of its first period have occurred
within the period before, so only stretches of triples that recur soon enough for their own length can
hold a run. The rest of a text, usually nearly all of it, never reaches the automaton.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from townads.llm.frames import table
from townads.llm.words import UNCHANGED, mixed, parts, rolling, words_of

EXPONENT = 4
LEAST = 6
BATCH_BYTES = 2 << 20  # texts that a task looks at together; a longer text alone
_GRAM = 3
_ROUNDS = 8  # of narrowing stretches; what is left too wide is only more work for the automaton
_BLANK = r"[\x20\x09-\x0D]+"


class _LastSeen:
    """Suffix automaton of the words read so far, its link tree as a link-cut tree.

    ``end[x]``, valid at the root of a splay tree, is where the substrings of its preferred path
    were seen last. Node 0 stands for none, node 1 is the empty string.
    """

    def __init__(self) -> None:
        self.length, self.link, self.next = [0, 0], [0, 0], [{}, {}]
        self.up, self.left, self.right, self.end = [0, 0], [0, 0], [0, 0], [-1, -1]
        self.last = 1

    def _node(self, length: int, follow: dict) -> int:
        for column, value in ((self.length, length), (self.link, 0), (self.next, follow), (self.up, 0)):
            column.append(value)
        for column, value in ((self.left, 0), (self.right, 0), (self.end, -1)):
            column.append(value)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while (p := up[x]) and (left[p] == x or right[p] == x):
            g = up[p]
            inner = g and (left[g] == p or right[g] == p)
            if inner:
                self._turn(p if (left[g] == p) == (left[p] == x) else x)
            else:
                self.end[x] = self.end[p]
            self._turn(x)

    def _turn(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            moved = left[p] = right[x]
            right[x] = p
        else:
            moved = right[p] = left[x]
            left[x] = p
        if moved:
            up[moved] = p
        up[p] = x
        up[x] = g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
            else:
                self.end[x] = self.end[p]
        else:
            self.end[x] = self.end[p]

    def read(self, word: int, at: int) -> list[tuple[int, int]]:
        """Appends a word; the (end, length) of the path segments that its class had before."""
        length, link, follow = self.length, self.link, self.next
        new = self._node(length[self.last] + 1, {})
        p = self.last
        while p and word not in follow[p]:
            follow[p][word] = new
            p = link[p]
        if not p:
            link[new] = 1
        else:
            q = follow[p][word]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = self._node(length[p] + 1, dict(follow[q]))
                # The copy stands right above q, in q's path, and was seen where q was.
                self._splay(q)
                above = self.left[copy] = self.left[q]
                if above:
                    self.up[above] = copy
                self.left[q], self.up[copy] = copy, q
                link[copy], link[q], link[new] = link[q], copy, copy
                while p and follow[p].get(word) == q:
                    follow[p][word] = copy
                    p = link[p]
        self.up[new] = link[new]
        self.last = new
        return self._access(new, at)

    def _access(self, node: int, at: int) -> list[tuple[int, int]]:
        up, right, end, length = self.up, self.right, self.end, self.length
        met, below, x = [], 0, node
        while x:
            self._splay(x)
            if end[x] >= 0:
                met.append((end[x], length[x]))
            if right[x]:
                end[right[x]] = end[x]
            right[x] = below
            below, x = x, up[x]
        self._splay(node)
        end[node] = at
        return met


def runs_of(words: list[int], exponent: int = EXPONENT, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``exponent`` periods and ``least`` words."""
    seen, out = _LastSeen(), []
    for i, word in enumerate(words):
        for end, length in seen.read(word, i):
            period = i - end
            whole = length + period
            if whole < exponent * period or whole < least:
                continue
            if i + 1 == len(words) or words[i + 1] != words[i + 1 - period]:
                out.append((i + 1 - whole, whole, period))
    return sorted(out, key=lambda run: (run[0], run[2]))


def _stretches(prints: np.ndarray, rows: np.ndarray, first: np.ndarray, exponent: int) -> np.ndarray:
    """[from, to) word ranges, each within one row, outside of which no run lies."""
    none = np.zeros((0, 2), dtype=np.int64)
    grams = rolling(prints, _GRAM)
    at = np.flatnonzero(rows[: len(grams)] == rows[_GRAM - 1 :]) if len(grams) else none[:, 0]
    if not len(at):
        return none
    # Value and position in one number, so that plain sorting brings equal triples of a row together in
    # order. Triples that only seem equal make stretches longer, never shorter.
    bits = np.uint64(max(1, int(len(prints)).bit_length()))
    place = at.astype(np.uint64)
    keys = np.sort((mixed(grams[at] + rows[at].astype(np.uint64)) >> bits << bits) | place)
    here = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    again = np.flatnonzero(keys[1:] >> bits == keys[:-1] >> bits) + 1
    back = np.zeros(len(prints) + 1, dtype=np.int64)
    back[here[again]] = here[again] - here[again - 1]
    flags = back > 0
    for _ in range(_ROUNDS):
        edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
        opens, closes = edges[::2], edges[1::2]
        reach = (closes - opens + _GRAM - 1) // (exponent - 1)
        marked = np.flatnonzero(flags)
        far = marked[back[marked] > np.repeat(reach, closes - opens)]
        if not len(far):
            break
        flags[far] = False
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    opens, closes = edges[::2], edges[1::2]
    reach = (closes - opens + _GRAM - 1) // (exponent - 1)
    low = np.maximum(opens - reach, first[rows[opens]]) if len(opens) else opens
    high = np.minimum(closes + _GRAM - 1, first[rows[opens] + 1]) if len(opens) else closes
    # Ranges that meet are one; a range may also reach back over several before it.
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order]) if len(order) else high
    if not len(low):
        return none
    fresh = np.append(True, low[1:] >= high[:-1])
    return np.stack([low[fresh], high[np.append(np.flatnonzero(fresh)[1:] - 1, len(high) - 1)]], axis=1)


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    best = None
    for run in runs:  # in order of start and period, so the first of equals stays
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _find(exponent: int, least: int, names: list[str], schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (part for batch in batches for part in parts(batch, "text", BATCH_BYTES)):
            words = words_of(rows["text"], UNCHANGED)
            found: dict[int, list] = {}
            for low, high in _stretches(words.prints, words.rows, words.first, exponent).tolist():
                _, named = np.unique(words.prints[low:high], return_inverse=True)
                row = int(words.rows[low])
                before = low - int(words.first[row])
                more = [(s + before, n, q) for s, n, q in runs_of(named.tolist(), exponent, least)]
                found.setdefault(row, []).extend(more)
            texts = rows["text"].combine_chunks().cast(pa.large_binary())
            made = {name: [] for name in ("n_words", "runs", "best", "collapsed")}
            for row, text in enumerate(texts):
                own = (text.as_py() or b"").split()
                runs = sorted(found.get(row, []), key=lambda r: (r[0], r[2]))
                keep = np.ones(len(own), dtype=bool)
                for start, length, period in runs:
                    keep[start + period : start + length] = False
                left = own if not runs else [word for word, stays in zip(own, keep.tolist()) if stays]
                made["n_words"].append(len(own))
                made["runs"].append(runs)
                made["best"].append(_best(runs))
                made["collapsed"].append(b" ".join(left))
            yield from pa.table([_column(n, made, rows) for n in names], schema=schema).to_batches()

    return run


def _column(name: str, made: dict[str, list], rows: pa.Table) -> pa.Array | pa.ChunkedArray:
    if name == "n_runs":
        return pa.array([len(runs) for runs in made["runs"]], pa.int64())
    if name == "runs":
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        return pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in made["runs"]], kind)
    if name in ("start", "length", "period"):
        i = ("start", "length", "period").index(name)
        return pa.array([best and best[i] for best in made["best"]], pa.int64())
    if name == "exponent_milli":
        return pa.array([best and 1000 * best[1] // best[2] for best in made["best"]], pa.int64())
    if name == "runs_sha256":
        lines = ("".join(f"{s},{n},{q}\n" for s, n, q in runs) for runs in made["runs"])
        return pa.array([hashlib.sha256(x.encode()).hexdigest() for x in lines], pa.string())
    if name == "collapsed_sha256":
        return pa.array([hashlib.sha256(x).hexdigest() for x in made["collapsed"]], pa.string())
    if name == "collapsed":
        return pa.array(made["collapsed"], pa.binary()).cast(pa.string())
    if name == "n_words":
        return pa.array(made["n_words"], pa.int64())
    return rows[name]


_KINDS = {
    "n_words": "long",
    "n_runs": "long",
    "runs": "array<struct<start:bigint,length:bigint,period:bigint>>",
    **dict.fromkeys(("start", "length", "period", "exponent_milli"), "long"),
    **dict.fromkeys(("runs_sha256", "collapsed_sha256", "collapsed"), "string"),
}


def find_runs(
    docs: DataFrame,
    id: str = "doc_id",
    text: str | Column = "text",
    exponent: int = EXPONENT,
    least: int = LEAST,
    outputs: tuple[str, ...] = ("n_words", "runs", "collapsed"),
) -> DataFrame:
    """Each row's id with the periodic runs of its text and the text without their repetitions.

    A run is a stretch of words (``[^ \\t-\\r]+``) with smallest period q, at least ``exponent`` * q and
    ``least`` long, that neither neighbouring word extends. Words of a run after its first q are dropped.

    Outputs to choose from: ``n_words``; ``n_runs``; ``runs`` by start and period; ``start``, ``length``,
    ``period`` and ``exponent_milli`` of the run with most periods (the first of equals; NULL without runs);
    ``collapsed``, the words kept, joined by one space; ``runs_sha256`` of lines ``start,length,period``;
    ``collapsed_sha256``.

    Nulls and edges: a null or empty text has no words and no runs, its collapsed text is empty; null and
    repeated ids are kept as they are, row by row; an empty table gives an empty one. Only the two columns are read,
    others may have any names. Words are compared by 64-bit values. ``exponent`` is at least 2, ``least`` 6.
    """
    if exponent < 2 or least < 6:
        raise ValueError("runs have at least two periods and six words")
    rows = docs.select(F.col(id).alias("own_id"), (F.col(text) if isinstance(text, str) else text).alias("text"))
    ddl = ", ".join([f"own_id {rows.schema['own_id'].dataType.simpleString()}", *(f"{n} {_KINDS[n]}" for n in outputs)])
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return rows.mapInArrow(_find(exponent, least, ["own_id", *outputs], schema), ddl).toDF(id, *outputs)


def _planted() -> Column:
    """The text; of a tenth of the documents, chosen by id, with its end replaced by repetitions."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.split(F.regexp_replace("text", rf"^{_BLANK}|{_BLANK}$", ""), _BLANK)
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    often = (F.floor((n - a) / p) + 1).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), often))
    changed = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), again), F.lit(1), n), " ")
    return F.when((h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), changed).otherwise(F.col("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, repetitions planted in a tenth of them, as numbers and digests."""
    outputs = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return find_runs(table(spark, sf_dir, "documents"), text=_planted(), outputs=outputs)


QUERIES = {"op11_periodic_runs": op11_periodic_runs}
