"""Personal data in whole texts: proposed by generous generators, chosen by boosted trees.

Strict rules give the base spans, which always count. Generators propose more: addresses with unusual or
spelled-out signs, any dotted or grouped run of digits, IPv6, long mixed strings. They may overlap. Boosted
trees judge them by format and context. There are no labels for personal data, so weak ones take their place:
a candidate counts as right if it covers a base span or if ``clear`` says so by what the trees don't see (a word
that announces it, a checksum, a valid form of the address, randomness). Clear candidates are always added.
Each kind has trees of its own, from all distinct candidates of the kind in the whole table; candidates with the
same text and context are one. Those with odd hashes are held out; on all of them the threshold of the kind is the
smallest score from which on at least ``PRECISION`` of the candidates are right. A kind with too few such rows
has its clear candidates only.

All scanning is linear in the length of the text.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.queries import query, table
from flowlens.operators.ranking import running_counts
from flowlens.workspace import discard, materialize

KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = (*KINDS, "secret")
#: Texts handled at once.
TEXTS = 256
TREES, DEPTH, SEED = 12, 3, 7
PRECISION, HELD_OUT_ROWS = 0.99, 20
#: A candidate that covers nearly a base span of its kind counts as right.
ALIKE = 0.8
#: Characters around a candidate that count as its context.
CONTEXT = 40

Span = tuple[str, int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGIT = re.compile(r"[0-9]")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SPELLED_AT = re.compile(r"[(\[{]at[)\]}]|\sat\s", re.IGNORECASE)
AFTER_AT = re.compile(r"\s?[A-Za-z0-9-]+(?:\s?(?:[(\[{]dot[)\]}]|\sdot\s|\.)\s?[A-Za-z0-9-]+)+", re.IGNORECASE)
ODD_LOCAL = re.compile(r"[^\s@<>()\[\],;:\"]")
ODD_DOMAIN = re.compile(r"[^\s@<>()\[\],;:\"]+")
DIGIT_RUN = re.compile(r"[0-9][0-9\x20().\-/]*+")
IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
#: Three groups of digits at least, two colons in one place: ``::`` between two names is no address.
SHORT_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:)+(?::[0-9A-Fa-f]{1,4})+(?![0-9A-Za-z:])")
LONG_STRING = re.compile(r"[A-Za-z0-9_/+=-]++")
LONG_STRING_CHARS = 20
ADDRESS_CHARS = 254
#: Words that announce a kind (fixed values); those for phones and secrets stand right before the span.
CUES = {
    "email": re.compile(r"mail|contact|write to", re.IGNORECASE),
    "card": re.compile(r"card|visa|master|credit|pay", re.IGNORECASE),
    "phone": re.compile(r"(?:phone|\btel|\bcall|\bfax|mobile)(?: us| me| number| no)?[\s.:]*\Z", re.IGNORECASE),
    "secret": re.compile(r"(?:token|secret|password|passwd|(?<![a-z])key|\bapi)(?: is)?[\s\"'`=:>]*\Z", re.IGNORECASE),
}
NAMED_VALUE = re.compile(r"[A-Za-z_-]+=(?!=)")
SPELLED_DOT = re.compile(r"\s?[(\[{]dot[)\]}]\s?|\sdot\s", re.IGNORECASE)
ADDRESS = re.compile(r"\w[\w.%+'-]*@(?:\w(?:[\w-]*\w)?\.)+[^\W\d_]{2,24}")
#: Bits per character of a random string.
RANDOM = 3.0


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Leftmost non-overlapping: at every @ the longest local part since the last match, and the domain."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            last = domain.end()
            yield "email", start, last
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """The spans of the four strict rules, by start and then kind."""
    found = list(emails(text))
    if DIGIT.search(text):
        for run in DOTTED.finditer(text):
            if run.group().count(".") < 3:
                continue
            parts = list(re.finditer(r"[0-9]+", run.group()))
            for i in range(0, len(parts) - 3, 4):
                if all(len(p := part.group().lstrip("0")) <= 3 and int(p or 0) <= 255 for part in parts[i : i + 4]):
                    found.append(("ip", run.start() + parts[i].start(), run.start() + parts[i + 3].end()))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str) -> list[Span]:
    """What the generous generators propose; base spans may be among it."""
    found: set[Span] = set()
    at = text.find("@")
    while at >= 0:
        start = at
        while start > max(0, at - ADDRESS_CHARS) and ODD_LOCAL.match(text[start - 1]):
            start -= 1
        domain = ODD_DOMAIN.match(text, at + 1, at + ADDRESS_CHARS)
        if start < at and domain:
            end = at + 1 + len(domain.group().rstrip(".!?'"))
            if end > at + 1:
                found.add(("email", start, end))
        at = text.find("@", at + 1)
    if " dot " in (low := text.lower()) or "dot)" in low or "dot]" in low or "(at)" in low or "[at]" in low:
        for m in SPELLED_AT.finditer(text):
            stop = m.start() - (m.start() > 0 and text[m.start() - 1].isspace())
            start = stop
            while start and text[start - 1] in LOCAL:  # the whole local part; no other "at" lies inside it
                start -= 1
            right = AFTER_AT.match(text, m.end(), m.end() + ADDRESS_CHARS)
            if start < stop and right:
                found.add(("email", start, right.end()))
                if sentence := re.search(r"\.\s", right.group()):  # the address may end a sentence
                    found.add(("email", start, right.start() + sentence.start()))
    if DIGIT.search(text):
        for m in DIGIT_RUN.finditer(text):
            run = m.group().rstrip(" ().-/")
            n = sum(c.isdigit() for c in run)
            if n >= 7:
                start = m.start()
                while start and text[start - 1] in "+(":
                    start -= 1
                found.add(("card" if n >= 13 else "phone", start, m.start() + len(run)))
            if run.count(".") >= 3:
                found.add(("ip", m.start(), m.start() + len(run)))
        if ":" in text:
            found.update(("ip", m.start(), m.end()) for m in IPV6.finditer(text))
        if "::" in text:
            for m in SHORT_IPV6.finditer(text):
                if len(m.group().replace("::", ":").split(":")) >= 3 and DIGIT.search(m.group()):
                    found.add(("ip", m.start(), m.end()))
        for m in LONG_STRING.finditer(text):
            named = NAMED_VALUE.match(m.group())
            for start in {m.start(), m.start() + (named.end() if named else 0)}:
                own = text[start : m.end()]
                if len(own) >= LONG_STRING_CHARS and DIGIT.search(own) and re.search("[A-Za-z]", own):
                    found.add(("secret", start, m.end()))
    return sorted(found, key=lambda s: (s[1], ADDED_KINDS.index(s[0]), s[2]))


def alike(a: Span, b: Span) -> float:
    """What two spans share of what they cover together."""
    return max(0, min(a[2], b[2]) - max(a[1], b[1])) / (max(a[2], b[2]) - min(a[1], b[1]))


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalnum() else 2


def _entropy(own: str) -> float:
    return -sum(n / len(own) * math.log2(n / len(own)) for n in Counter(own).values())


def clear(text: str, span: Span) -> bool:
    """Whether a candidate is personal data by signs that ``features`` leaves out."""
    kind, start, end = span
    own, before = text[start:end], text[max(0, start - CONTEXT) : start]
    if kind == "ip":  # dotted ones have a strict rule
        try:
            return ":" in own and ipaddress.ip_address(own).version == 6
        except ValueError:
            return False
    if kind == "email":
        plain = SPELLED_DOT.sub(".", own)
        spelled = "@" not in own
        if spelled:  # "at" between blanks is a common word
            if not re.search(r"[(\[{]at[)\]}]", own, re.IGNORECASE) and not (plain != own and CUES[kind].search(before)):
                return False
            plain = re.sub(r"\s?@\s?", "@", SPELLED_AT.sub("@", plain, count=1))
        return bool(ADDRESS.fullmatch(plain))
    digits = "".join(c for c in own if c in "0123456789")
    if kind == "secret":
        return _entropy(own) >= RANDOM and bool(CUES[kind].search(before))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and bool(CUES[kind].search(before))
    return 7 <= len(digits) <= 15 and own.count(".") < 4 and bool(CUES[kind].search(before))


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate, without the signs that make it ``clear``."""
    kind, start, end = span
    own = text[start:end]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    digits = [c for c in own if c in "0123456789"]
    groups = re.findall(r"[0-9]+", own)
    separators = [c for c in own if not c.isalnum()]
    return [
        len(own), len(digits), sum(c.isalpha() for c in own), len(separators),
        len(set(separators)), len(groups), max(map(len, groups), default=0), "@" in own, own.count("."),
        own.startswith("+"), _entropy(own), bool(re.fullmatch(r"[0-9a-f]+", own)), _side(before[-1:]), _side(after[:1]),
        sum(c in "0123456789" for c in before + after) / max(1, len(before + after)),
    ]


@dataclass
class Judge:
    """Boosted trees as arrays (feature, threshold, left, right, value), and the judges of the kinds with their thresholds."""

    trees: list[tuple[np.ndarray, ...]]
    weights: list[float]
    thresholds: dict[str, float]
    of_kind: dict[str, Judge] = field(default_factory=dict)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for (feature, border, left, right, value), weight in zip(self.trees, self.weights):
            at = np.zeros(len(rows), dtype=np.int64)
            while (inner := feature[at] >= 0).any():
                low = rows[np.arange(len(rows)), np.maximum(feature[at], 0)] <= border[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            total += weight * value[at]
        return total

    def chosen(self, text: str) -> list[Span]:
        proposed = candidates(text)
        right = [clear(text, s) for s in proposed]
        for kind, threshold in self.thresholds.items():
            at = [i for i, s in enumerate(proposed) if s[0] == kind and not right[i]]
            if at:
                rows = np.array([features(text, proposed[i]) for i in at], dtype=float)
                for i, score in zip(at, self.of_kind[kind].scores(rows)):
                    right[i] = score >= threshold
        return [s for s, good in zip(proposed, right) if good]


def _tree(model) -> tuple[np.ndarray, ...]:
    nodes: list[list[float]] = []

    def walk(node) -> int:
        own = len(nodes)
        nodes.append([-1, 0.0, 0, 0, node.prediction()])
        if node.subtreeDepth():
            split = node.split()
            nodes[own][:2] = split.featureIndex(), split.threshold()
            nodes[own][2], nodes[own][3] = walk(node.leftChild()), walk(node.rightChild())
        return own

    walk(model._call_java("rootNode"))
    feature, border, left, right, value = map(np.array, zip(*nodes))
    return feature.astype(int), border, left.astype(int), right.astype(int), value


def _sample_hash(text: str, span: Span) -> int:
    """The same for the same candidate in the same context, in whatever document."""
    kind, start, end = span
    seen = (kind, text[max(0, start - CONTEXT) : start], text[start:end], text[end : end + CONTEXT])
    return int.from_bytes(hashlib.blake2b("\0".join(seen).encode(errors="replace"), digest_size=8).digest(), "big", signed=True)


def _in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from (batch.slice(at, TEXTS) for at in range(0, batch.num_rows, TEXTS))


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The distinct candidates of all documents: ``h``, ``kind``, ``features``, ``label``."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _in_parts(batches):
            found: dict[int, tuple[int, str, list[float], float]] = {}
            for text in part.column(0).to_pylist():
                text = text or ""
                strict = base_spans(text)
                for span in set(strict) | set(candidates(text)):
                    h = _sample_hash(text, span)
                    near = [s for s in strict if s[0] == span[0] and s[1] < span[2] and span[1] < s[2]] if span[0] in KINDS else []
                    right = float(any(alike(s, span) >= ALIKE for s in near) or clear(text, span))
                    if h not in found or found[h][3] < right:
                        found[h] = h, span[0], [float(x) for x in features(text, span)], right
            columns = [list(x) for x in zip(*found.values())] or [[], [], [], []]
            types = [pa.int64(), pa.string(), pa.list_(pa.float64()), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["h", "kind", "features", "label"])

    every = rows.mapInArrow(run, "h long, kind string, features array<double>, label double")
    return every.groupBy("h", "kind", "features").agg(F.max("label").alias("label"))


def scored(rows: DataFrame, judge: Judge) -> DataFrame:
    """``score`` and ``label`` of training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                width = len(batch.column("features")[0])
                given = batch.column("features").flatten().to_numpy().reshape(-1, width)
                yield pa.RecordBatch.from_arrays([pa.array(judge.scores(given)), batch.column("label")], ["score", "label"])

    return rows.select("features", "label").mapInArrow(run, "score double, label double")


def fit_judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Judge:
    """Boosted trees and a threshold for each kind from all candidates; without both labels clear candidates only."""
    rows = materialize(training_rows(docs, id_col, text_col), "pii-training")
    odd = F.col("h") % 2 != 0
    sizes = {(r.kind, r.odd, r.label): r.n for r in rows.groupBy("kind", odd.alias("odd"), "label").agg(F.count("*").alias("n")).collect()}
    judge = Judge([], [], {})
    for kind in ADDED_KINDS:
        if sizes.get((kind, True, 1.0), 0) < HELD_OUT_ROWS or not all((kind, False, x) in sizes for x in (0.0, 1.0)):
            continue
        of_kind = rows.where(F.col("kind") == kind)
        learner = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=SEED)
        model = learner.fit(of_kind.where(~odd).select("label", array_to_vector("features").alias("vector")))
        judge.of_kind[kind] = Judge([_tree(t) for t in model.trees], list(model.treeWeights), {})
        # equal scores stand or fall together
        ranked = running_counts(scored(of_kind.where(odd), judge.of_kind[kind]), "score", {"n": F.lit(1), "good": F.col("label")})
        lowest = ranked.where(F.col("cum_good") >= PRECISION * F.col("cum_n")).agg(F.min("score")).first()[0]
        if lowest is not None:
            judge.thresholds[kind] = lowest
    discard(rows)
    return judge


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def all_spans(text: str, judge: Judge) -> tuple[list[Span], list[Span]]:
    """The base spans, and these with those that the judge adds."""
    base = base_spans(text)
    every = set(base) | set(judge.chosen(text))
    return base, sorted(every, key=lambda s: (s[1], ADDED_KINDS.index(s[0]), s[2]))


def find(docs: DataFrame, judge: Judge | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``base`` and ``spans``, arrays of (kind, start, end) in code points.

    A null text counts as empty; empty texts have no spans; repeated rows and null ids are kept; an empty
    table gives no rows; further columns are ignored. ``judge`` is fitted on ``docs`` if not given.
    """
    judge = judge or fit_judge(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_parts(batches):
            found = [all_spans(x.as_py() or "", judge) for x in batch.column(1)]
            named = [[[dict(zip(("kind", "start", "end"), s)) for s in x[i]] for x in found] for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, span) for x in named)], [id_col, "base", "spans"]
            )

    item = "array<struct<kind:string,start:long,end:long>>"
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, base {item}, spans {item}"
    )


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each stretch that spans cover replaced by the kind of its first span."""
    parts, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        parts += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, judge: Judge | None = None, id_col: str = "doc_id", text_col: str = "text",
           length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data in the text replaced; all columns and rows stay, clean texts unchanged.

    A null text stays null. ``length_col``, where there is one, is set anew for the texts that changed.
    """
    judge = judge or fit_judge(docs, id_col, text_col)
    names = docs.columns
    at, length_at = names.index(text_col), names.index(length_col) if length_col in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_parts(batches):
            columns = list(batch.columns)
            old = columns[at].to_pylist()
            new = [x and redacted(x, all_spans(x, judge)[1]) for x in old]
            columns[at] = pa.array(new, columns[at].type)
            if length_at is not None:
                given = columns[length_at]
                lengths = [n if a == b else len(b) for n, a, b in zip(given.to_pylist(), old, new)]
                columns[length_at] = pa.array(lengths, given.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


@query("op1_pii")
def op1_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = find(table(spark, sf, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    text = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )
    return found.select(
        "doc_id", *map(number, KINDS), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans")
    )
