"""URL rules: a bit-parallel wildcard automaton that follows all glob rules over a URL at once.

A rule is a glob over the canonical URL, which is the host in lower case and the path after it. ``*``
stands for any bytes but a slash, ``**`` for any bytes, ``?`` for one byte that is no slash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SLASH = ord("/")


@dataclass(frozen=True)
class Automaton:
    """State i of a rule means that i of its atoms are matched; states of all rules lie end to end in words
    of 64 bits."""

    words: int
    step: np.ndarray  # [256, words] states that a byte leads to from the state before
    stay: np.ndarray  # [256, words] states that a byte leaves as they are (a wildcard follows)
    begin: np.ndarray  # [words] first states
    accept: np.ndarray  # bit number of each rule's last state


def atoms(glob: str) -> tuple[list[int | None], dict[int, str]]:
    """The atoms of a glob (a byte, or None for ?), and by the number of atoms before it each wildcard."""
    out, wild, data, i = [], {}, glob.encode(), 0
    while i < len(data):
        if data[i] == ord("*"):
            j = i
            while j < len(data) and data[j] == ord("*"):
                j += 1
            wild[len(out)] = "any" if j - i > 1 else "part"
            i = j
        else:
            out.append(None if data[i] == ord("?") else data[i])
            i += 1
    return out, wild


def build(globs: Sequence[str]) -> Automaton:
    parsed = [atoms(g) for g in globs]
    total = sum(len(a) + 1 for a, _ in parsed)
    words = max(1, -(-total // 64))
    step, stay = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
    begin, accept, at = np.zeros(words, np.uint64), [], 0
    part = np.arange(256) != SLASH

    def put(table: np.ndarray, rows, bit: int) -> None:
        table[rows, bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    for parts, wild in parsed:
        begin[at // 64] |= np.uint64(1) << np.uint64(at % 64)
        for i, byte in enumerate(parts, 1):
            put(step, part if byte is None else byte, at + i)
        for i, kind in wild.items():
            put(stay, part if kind == "part" else slice(None), at + i)
        accept.append(at + len(parts))
        at += len(parts) + 1
    return Automaton(words, step, stay, begin, np.array(accept, np.int64))


def run(a: Automaton, urls: Sequence[bytes]) -> np.ndarray:
    """[urls, rules] whether each rule matches each whole URL; all URLs advance together, byte by byte."""
    lengths = np.array([len(u) for u in urls], np.int64)
    order = np.argsort(-lengths, kind="stable")  # those that have ended lie behind those that have not
    data = np.frombuffer(b"".join([urls[i] for i in order]), np.uint8)
    sizes = lengths[order]
    begins = np.cumsum(sizes) - sizes
    state = np.tile(a.begin, (len(urls), 1))
    alive = len(urls)
    for t in range(int(sizes[0]) if len(urls) else 0):
        while sizes[alive - 1] <= t:
            alive -= 1
        byte, now = data[begins[:alive] + t], state[:alive]
        moved = now << np.uint64(1)
        moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
        state[:alive] = (moved & a.step[byte]) | (now & a.stay[byte])
    hits = np.empty((len(urls), len(a.accept)), bool)
    hits[order] = (state[:, a.accept // 64] >> (a.accept % 64).astype(np.uint64)) & np.uint64(1) > 0
    return hits


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit(""))


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def after_scheme(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    place = F.instr(url, "://")
    return F.when(place > 0, F.substring(url, place + 3, F.length(url)))


@dataclass(frozen=True)
class Rule:
    """``domain`` and its subdomains, below ``path``."""

    domain: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.domain + self.path

    @property
    def globs(self) -> tuple[str, str]:
        # A host has no slash, so * cannot leave it.
        return f"{self.domain}{self.path}**", f"*.{self.domain}{self.path}**"


def judged(
    pages: DataFrame, rules: Sequence[Rule], block: Sequence[str], page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule`` (the longest that fits, of equally long ones
    the first; else null), ``glob`` (the first of ``block`` that matches, else null) and ``verdict``: the
    rule's, else block if a glob matches, else allow.

    A null URL, or one without ``://``, has an empty host and path, fits no rule and is allowed unless a glob
    matches an empty text. Rows are judged each for itself, so repeated rows and other columns do not
    matter.
    """
    automaton = build([g for rule in rules for g in rule.globs] + list(block))
    names = [r.name for r in rules]
    ranked = sorted(range(len(rules)), key=lambda i: -len(names[i]))
    verdicts = [r.verdict for r in rules]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch["host"].to_pylist(), batch["path"].to_pylist()
            hits = run(automaton, [(h + p).encode() for h, p in zip(hosts, paths)])
            fits = hits[:, : 2 * len(rules)].reshape(len(hosts), len(rules), 2).any(axis=2)
            rule = np.full(len(hosts), -1)
            for i in reversed(ranked):
                rule[fits[:, i]] = i
            bad = hits[:, 2 * len(rules):]
            first = np.where(bad.any(axis=1), bad.argmax(axis=1) if bad.shape[1] else 0, -1)
            yield pa.RecordBatch.from_arrays([
                batch["page_id"], batch["host"], batch["path"],
                pa.array([names[i] if i >= 0 else None for i in rule], pa.string()),
                pa.array([block[i] if i >= 0 else None for i in first], pa.string()),
                pa.array([verdicts[i] if i >= 0 else "block" if j >= 0 else "allow" for i, j in zip(rule, first)], pa.string()),
            ], names=["page_id", "host", "path", "rule", "glob", "verdict"])

    parts = pages.select(F.col(f"`{page_id}`").alias("page_id"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    return parts.mapInArrow(judge, "page_id long, host string, path string, rule string, glob string, verdict string")
