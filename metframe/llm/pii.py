"""Personal data by bootstrapped contextual extraction.

Identifiers that fixed formats prove are the seeds. The words before them are lexical patterns. Patterns
and the identifier-like strings that follow them form a graph, on which Spark scores patterns by the known
instances they introduce and strings by the patterns that introduce them, round by round. Strings that
patterns of high confidence vouch for are identifiers too.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from metframe.llm.text import corpus, fresh, keyed, meets, pieces_of, row_key, small
from metframe.session import cut_lineage

KINDS = ["email", "ip", "card", "phone"]
OTHER = "other"

# The formats of seeds.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Strings that look like an identifier of a kind without having its format, and other strings with digits.
LIKE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}){1,4}"),
    "ip": re.compile(r"(?<![0-9A-Za-z.:-])(?:[0-9]{1,3}(?:[-_][0-9]{1,3}){3}|[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{0,4}){3,7})(?![0-9A-Za-z:_-])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?[ ./-][0-9]{2,4}(?:[ ./-]?[0-9]{2,4}){1,3}(?![0-9A-Za-z])"),
    "card": re.compile(r"(?<![0-9A-Za-z.+-])[0-9](?:[ -]?[0-9]){11,18}(?![0-9A-Za-z])"),
}
DIGITS = re.compile(r"[^\s]{0,40}[0-9][^\s]{0,40}")
WORD = re.compile(r"[^\W\d_]+")
GATE = re.compile(r"[0-9@]|[(\[]at[)\]]")

NEAR = 48  # characters before a string in which its pattern is sought; a word that begins before them is whole
SUPPORT = 8  # different known instances that a pattern must introduce
CONFIDENCE = 0.8  # of a pattern, as the lower end of its interval, and of a string
Z = 1.28  # of that interval


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, found from their @; linear in any text."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        else:
            end = max(end, at + 1)
        at = text.find("@", end)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small_number(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def seeds(text: str) -> list[tuple[str, int, int]]:
    """Spans that the formats prove, by kind as listed, then by start."""
    out = [("email", *s) for s in emails(text)]
    for m in IP.finditer(text):
        if all(map(small_number, m[0].split("."))):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(digits_of(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint stretches that the spans cover."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def alikes(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Identifier-like strings that overlap neither a seed nor each other, and other strings with digits."""
    out, spans = [], [(a, b) for _, a, b in taken]
    for kind, shape in [*LIKE.items(), (OTHER, DIGITS)]:
        starts, ends = merged(spans)
        for m in shape.finditer(text):
            i = bisect.bisect_left(starts, m.end())  # stretches before i begin before the match ends
            if i == 0 or ends[i - 1] <= m.start():
                out.append((kind, *m.span()))
                spans.append(m.span())
    return out


def pattern(text: str, start: int) -> str:
    """The last two words before a place, in lower case. Where there are no two, what there is after a mark
    that tells whether the text begins there."""
    begin = max(0, start - NEAR)
    if WORD.match(text, begin):
        while begin > 0 and WORD.match(text[begin - 1]):
            begin -= 1
    words = [w if len(w) <= NEAR else hashlib.sha256(w.encode()).hexdigest() for w in WORD.findall(text[begin:start].lower())[-2:]]
    return " ".join(words if len(words) > 1 else ["..." if begin else "^", *words])


def told(spans: list[tuple[str, int, int]]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1], s[2])))


FOUND = (
    "doc_id long, row_key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string,"
    " marks array<struct<kind: string, start: int, end: int, pattern: string, instance: string, known: boolean>>"
)
MARK = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pattern", pa.string()), ("instance", pa.string()), ("known", pa.bool_()),
]))


def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds of every document, and all marks: seeds and identifier-like strings with their patterns."""
    for batch in pieces_of(batches):
        columns: list[list] = [[] for _ in range(7)]
        for text in batch["text"].to_pylist():
            own = seeds(text) if GATE.search(text) else []
            marks = [(s, True) for s in own] + [(s, False) for s in alikes(text, own)] if GATE.search(text) else []
            counts = [sum(k == kind for k, _, _ in own) for kind in KINDS]
            base = told(own)
            rows = [
                {"kind": k, "start": a, "end": b, "pattern": pattern(text, a), "instance": re.sub(r"[\s().-]+", "", text[a:b].lower()), "known": known}
                for (k, a, b), known in marks
            ]
            for column, value in zip(columns, [*counts, hashlib.sha256(base.encode()).hexdigest(), base, rows]):
                column.append(value)
        arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string(), pa.string(), MARK])]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row_key"], *arrays], names=[
            "doc_id", "row_key", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "marks"])


def lower_end(share: Column, n: Column) -> Column:
    """The lower end of the score interval of a share among n."""
    z2 = Z * Z
    return (share + z2 / (2 * n) - Z * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def bootstrap(marks: DataFrame, support: int, confidence: float) -> DataFrame:
    """(kind, instance) of the strings that patterns vouch for.

    ``marks`` has kind, pattern, instance and whether a format proves it. A pattern's confidence in a kind is
    the lower end of the share of its strings that are known instances of the kind, other strings with
    digits being its misses. A string's is the noisy-or of its patterns. Strings are added until a round adds none.
    """
    edges = cut_lineage(marks.groupBy("pattern", "kind", "instance").agg(F.max("known").alias("known")))
    strings = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    accepted = cut_lineage(edges.where("known").select("kind", "instance").distinct())
    before, now = -1, accepted.count()
    while now > before:
        known = edges.join(accepted, ["kind", "instance"]).groupBy("pattern", "kind").agg(F.count("*").alias("hits"))
        scored = known.where(F.col("hits") >= support).join(strings, "pattern")
        good = scored.withColumn("sure", lower_end(F.col("hits") / F.col("n"), F.col("n"))).where(F.col("sure") >= confidence)
        vouched = edges.where("not known").join(good.select("pattern", "kind", "sure"), ["pattern", "kind"])
        score = 1 - F.exp(F.sum(F.log1p(-F.least(F.col("sure"), F.lit(1 - 1e-9)))))
        fresh = vouched.groupBy("kind", "instance").agg(score.alias("score")).where(F.col("score") >= confidence).select("kind", "instance")
        accepted = cut_lineage(accepted.union(fresh).distinct())
        before, now = now, accepted.count()
    return accepted


def personal_data(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", support: int = SUPPORT, confidence: float = CONFIDENCE
) -> DataFrame:
    """One row per document: ``doc_id``, ``row_key``, the number of proven identifiers of each kind,
    ``base_sha256`` of their spans and ``spans``, all spans as kind:start:end in code points, proven or
    vouched for by patterns.

    An identifier-like string is added wherever it stands, if it is accepted anywhere in the corpus. Added spans overlap neither proven ones nor each other. Null and empty texts have none. Null ids
    and repeated rows are kept, each in a row.
    """
    base = corpus(docs, doc_id, text)
    found = cut_lineage(base.select("doc_id", row_key().alias("row_key"), "text").mapInArrow(find, FOUND))
    each = found.select("doc_id", "row_key", F.inline("marks"))
    marks = cut_lineage(each.distinct())
    accepted = bootstrap(marks.select("pattern", "kind", "instance", "known"), support, confidence)
    new = marks.where(~F.col("known") & (F.col("kind") != OTHER)).join(accepted, ["kind", "instance"], "left_semi")
    added = new.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    added = added.select(F.col("doc_id").alias("id"), F.col("row_key").alias("key"), "added")
    rows = found.drop("marks").join(added, (F.col("row_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    return rows.select(
        "doc_id", "row_key", *(f"n_{k}" for k in KINDS), "base_sha256", all_spans(F.col("base"), F.col("added")).alias("spans")
    )


def all_spans(base: Column, added: Column) -> Column:
    """Proven and added spans in one text, by kind as listed, then by start."""
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])

    def parsed(x: Column) -> Column:
        parts = F.split(x, ":")
        return F.struct(order[parts[0]].alias("o"), parts[1].cast("int").alias("start"), parts[2].cast("int").alias("end"), parts[0].alias("kind"))

    proven = F.transform(F.filter(F.split(base, ","), lambda x: x != ""), parsed)
    more = F.transform(added, lambda x: F.struct(order[x["kind"]].alias("o"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    joined = F.array_join(F.transform(F.array_sort(F.concat(proven, more)), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return F.when(added.isNull(), base).otherwise(joined)


def mask(text: str, spans: str) -> str:
    """The text with every span replaced by its kind in brackets; spans that overlap go as one."""
    parts = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s))
    out, end = [], 0
    for a, b, kind in parts:
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join(out) + text[end:]


def masker(names: list[str], text: str, spans: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, text=text):
            pairs = zip(batch[text].to_pylist(), batch[spans].to_pylist())
            new = pa.array([mask(t, s) if t and s else t for t, s in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([new if n == text else batch[n] for n in names], names=names)

    return run


def masked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with their personal data masked, all columns and rows kept."""
    key, spans = fresh(docs, "row_key"), fresh(docs, "spans")
    found = personal_data(docs, doc_id, text, **options).where("spans <> ''").select("doc_id", "row_key", "spans")
    found = small(cut_lineage(found.distinct()), F.octet_length("spans") + 64)
    whole = keyed(docs, key, doc_id, text)
    joined = whole.join(found, meets(whole, key, found, doc_id), "left")
    rows = joined.select(*(whole[f"`{c}`"] for c in docs.columns), found["spans"].alias(spans))
    return rows.mapInArrow(masker(docs.columns, text, spans), docs.schema)
