"""URL filter: a bit-parallel wildcard automaton.

Every rule is a glob over the canonical form ``.host/path`` of a URL. All globs
are packed side by side into 64-bit words of Shift-And masks, so one shift, one
"and" and one "or" per URL byte advance every rule at once; numpy does that step
for a whole Arrow batch of URLs. Globs know ``*`` (any run), ``~`` (any run
without ``/``, for the host part) and ``?`` (one byte).

Canonical form: the host is what follows the first ``://`` up to ``/``, ``?``,
``#`` or the end, A-Z lower-cased; the path follows up to ``?``, ``#`` or the
end. A null URL, or one without ``://``, has an empty host and path.

There is no shuffle and nothing but the masks (rules x bytes) goes to executors.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeq.llm import textvec


@dataclass(frozen=True)
class Glob:
    """A glob over ``.host/path`` with its verdict. ``name`` is what is reported
    (None: the rule decides without being named); the fit with the largest
    ``rank`` wins, the first of the list among equals."""
    pattern: str
    verdict: str
    name: str | None = None
    rank: int = 0


def host_rule(host: str, path: str, verdict: str) -> Glob:
    """A rule on a host with its subdomains and on the start of the path."""
    return Glob(f"~.{host}{path}*", verdict, host + path, 1000 + len(host + path))


def host_word(word: str, verdict: str) -> Glob:
    """A rule on a word anywhere in the host."""
    return Glob(f"~{word}*", verdict)


class Automaton:
    """Masks of all globs: ``step`` bits are entered from the left neighbour on a
    byte, ``loop`` bits stay set on a byte, ``accept`` bits end a glob."""

    def __init__(self, globs: Sequence[Glob]):
        states: list[tuple[int, set[int] | None, set[int] | None]] = []  # glob, bytes in, bytes staying
        accept, start = [], []
        every, host = set(range(256)), set(range(256)) - {ord("/")}
        for g, glob in enumerate(globs):
            start.append(len(states))
            states.append((g, None, set()))
            for ch in glob.pattern.encode():
                if ch in b"*~":
                    states[-1] = (*states[-1][:2], (every if ch == ord("*") else host) | states[-1][2])
                else:
                    states.append((g, every if ch == ord("?") else {ch}, set()))
            accept.append(len(states) - 1)
        self.words = max(1, -(-len(states) // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.loop = np.zeros((256, self.words), np.uint64)
        for i, (_, enter, stay) in enumerate(states):
            for table, chars in ((self.step, enter), (self.loop, stay)):
                for c in chars or ():
                    table[c, i // 64] |= np.uint64(1) << np.uint64(i % 64)
        self.start = np.zeros(self.words, np.uint64)
        for i in start:
            self.start[i // 64] |= np.uint64(1) << np.uint64(i % 64)
        self.accept = accept

    def fits(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Rows x globs: does the glob fit the whole row?"""
        length = np.diff(offs)
        order = np.argsort(-length, kind="stable")
        state = np.tile(self.start, (len(length), 1))
        begin, falling = offs[:-1][order], -length[order]
        one, top = np.uint64(1), np.uint64(63)
        for j in range(int(length.max(initial=0))):
            live = int(np.searchsorted(falling, -j, "left"))  # rows longer than j
            d, c = state[:live], data[begin[:live] + j]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> top
            state[:live] = (moved & self.step[c]) | (d & self.loop[c])
        out = np.empty((len(length), len(self.accept)), bool)
        for g, i in enumerate(self.accept):
            out[order, g] = (state[:, i // 64] >> np.uint64(i % 64)) & one
        return out


def judge_urls(df: DataFrame, globs: Sequence[Glob], default: str = "allow",
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Return id, url, host, path, rule and verdict of every row.

    Edge cases: null or empty URLs and URLs without ``://`` have empty host and
    path and so get ``default`` unless a glob fits the bare ``.``; repeated rows
    are judged alike and all kept; other columns of ``df``, whatever their
    names, are not read; an empty table gives an empty result.
    """
    rest = F.when(F.instr(url_col, "://") > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)"))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    thin = df.select(F.col(id_col), F.col(url_col).alias("url"),
                     F.coalesce(host, F.lit("")).alias("host"),
                     F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"))
    rank = np.array([g.rank for g in globs], np.int64)
    best_first = sorted(range(len(globs)), key=lambda i: (-rank[i], i))
    ordered = [globs[i] for i in best_first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(ordered)
        names = np.array([g.name for g in ordered] + [None], object)
        verdicts = np.array([g.verdict for g in ordered] + [default], object)
        for b in batches:
            subject = pa.compute.binary_join_element_wise(pa.scalar("."), b["host"], b["path"], "")
            won = [np.zeros(0, np.int64)]
            for _, _, data, offs in textvec.slices(subject):
                fit = automaton.fits(data, offs)
                won.append(np.where(fit.any(1), fit.argmax(1), len(ordered)) if len(ordered)
                           else np.zeros(len(offs) - 1, np.int64))
            won = np.concatenate(won)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(names[won], pa.string()), pa.array(verdicts[won], pa.string())],
                names=[*b.schema.names, "rule", "verdict"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in thin.schema.fields)
    return thin.mapInArrow(run, f"{fields}, rule string, verdict string")
