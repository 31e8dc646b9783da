"""How the tokens of two tokenizers lie over the same bytes, and how often each pair of tokens meets.

Both tokenizers cut a text's bytes. Where both end a token, the text is cut into groups. They are found by divide and
conquer: of an interval's tokens, the end of the first tokenizer that is nearest the middle is looked up by
bisection among the ends of the second; if it isn't there, its neighbours follow, outwards. At the first
common end the interval falls into two; an interval without any is a group. All intervals of one depth are
treated at once, in numpy.

Inside a group two tokens are linked if their bytes overlap. How often a pair of tokens is linked in the whole
corpus is a grouped sum. So that documents needn't send every link through an exchange, the tasks gather
documents in packets of some megabytes of text: each packet counts its distinct pairs once and asks for
their totals once, while documents keep packed numbers of their packet's pairs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import bpe
from flowlens.llm.queries import query, table
from flowlens.workspace import materialize

#: Texts are aligned in runs of about so many bytes and counted in packets of so many.
RUN_BYTES, PACKET_BYTES = 1 << 19, 1 << 23
LONG_SPACE = re.compile(r"\s{10000}")
SPACE = "▁"  # how the second vocabulary writes a space

#: Numbers below 65,536 as decimal digits, right-aligned, with room for a separator behind.
_NUMBERS = np.arange(1 << 16)
DIGITS = np.stack([_NUMBERS // 10**k % 10 + 48 for k in (4, 3, 2, 1, 0)] + [_NUMBERS * 0], axis=1).astype(np.uint8)
SHOWN = np.stack([_NUMBERS >= 10**k for k in (4, 3, 2, 1)] + [_NUMBERS >= 0] * 2, axis=1)
WIDTH = SHOWN.sum(axis=1)
PARTS = "packet long, doc_id {}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, key long, n long"


def first_encoder(definition: str):
    """Token ids of a text by a byte-level vocabulary (the JSON text of its file), and the bytes of each id.

    Strings of special tokens are ordinary text. The faster library gives up on texts with a very long run of
    white space, which the other one reads with the same result.
    """
    import tiktoken
    from tokenizers import Tokenizer

    patient = Tokenizer.from_str(definition)
    patient.encode_special_tokens = True
    given, names = json.loads(definition)["model"], bpe.byte_names()
    raw = {bytes(names[c] for c in name): i for name, i in given["vocab"].items() if all(c in names for c in name)}
    made = [given["vocab"][left + right] for left, right in (m if isinstance(m, list) else m.split(" ") for m in given["merges"])]
    if made != sorted(made):
        raise ValueError("the merges must be in the order of their ids")
    ranks = dict(raw)
    for special in json.loads(definition).get("added_tokens", []):
        ranks.pop(special["content"].encode(), None)
    encoding = tiktoken.Encoding("first", pat_str=bpe.WORDS, mergeable_ranks=ranks, special_tokens={})
    parts = [b""] * (max(ranks.values()) + 1)
    for part, i in ranks.items():
        parts[i] = part

    def encode(text: str) -> list[int]:
        if LONG_SPACE.search(text):
            return patient.encode(text, add_special_tokens=False).ids
        return encoding.encode_ordinary(text)

    return encode, parts


def second_encoder(model: bytes):
    """Token ids of a text by a piece model that puts a space in front, and the bytes of each id."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [processor.id_to_piece(i) for i in range(processor.vocab_size())]
    if any(SPACE in x.lstrip(SPACE) for x in pieces) or pieces[processor.encode("a")[0]] not in (SPACE, SPACE + "a"):
        raise ValueError("pieces must begin at spaces and texts with one")
    parts = [
        bytes([int(x[3:5], 16)]) if processor.is_byte(i) else x.replace(SPACE, " ").encode() for i, x in enumerate(pieces)
    ]
    return processor.encode, parts


def common_ends(a: np.ndarray, b: np.ndarray, a_to: np.ndarray, b_to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cuts of texts that lie one behind the other, as numbers of tokens in front of them.

    ``a`` and ``b`` are the ends of all tokens, ascending; ``a_to`` and ``b_to`` the numbers of tokens up to
    the end of each text, where both have one.
    """
    found = [(a_to, b_to)]
    a_from, b_from = np.append(0, a_to[:-1]), np.append(0, b_to[:-1])
    while len(a_to):
        # an interval with a single token on one side has no end inside
        open_ = np.flatnonzero((a_to - a_from > 1) & (b_to - b_from > 1))
        a_from, a_to, b_from, b_to = a_from[open_], a_to[open_], b_from[open_], b_to[open_]
        start = np.where(a_from > 0, a[a_from - 1], 0)
        middle = np.searchsorted(a, (start + a[a_to - 1]) // 2)
        middle = np.clip(middle, a_from, a_to - 2)
        a_cut, b_cut = np.full(len(middle), -1), np.full(len(middle), -1)
        seeking, step = np.arange(len(middle)), 0
        while len(seeking):
            for at in ((middle[seeking] + step), (middle[seeking] - step))[: 1 + (step > 0)]:
                inside = np.flatnonzero((at >= a_from[seeking]) & (at <= a_to[seeking] - 2) & (a_cut[seeking] < 0))
                at, who = at[inside], seeking[inside]
                end = a[at]
                place = np.searchsorted(b, end)
                hit = b[place] == end
                a_cut[who[hit]], b_cut[who[hit]] = at[hit] + 1, place[hit] + 1
            step += 1
            m = middle[seeking]
            more = (a_cut[seeking] < 0) & ((m + step <= a_to[seeking] - 2) | (m - step >= a_from[seeking]))
            seeking = seeking[more]
        halved = np.flatnonzero(a_cut >= 0)
        a_cut, b_cut = a_cut[halved], b_cut[halved]
        found.append((a_cut, b_cut))
        a_from, a_to = np.concatenate([a_from[halved], a_cut]), np.concatenate([a_cut, a_to[halved]])
        b_from, b_to = np.concatenate([b_from[halved], b_cut]), np.concatenate([b_cut, b_to[halved]])
    return tuple(np.sort(np.concatenate(x)) for x in zip(*found))


def links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens that overlap: each stretch between neighbouring ends lies in one token of either side."""
    ends = np.concatenate([a, b])
    ends.sort(kind="stable")
    ends = ends[np.append(True, ends[1:] != ends[:-1])] if len(ends) else ends
    return np.searchsorted(a, ends), np.searchsorted(b, ends)


def groups_text(a_ids, b_ids, a_cut, b_cut) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2;`` as bytes, and the end of each group in it."""
    na, nb = np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0)
    n = len(a_ids) + len(b_ids)
    ids, mark = np.empty(n, dtype=np.int64), np.full(n, ord(","), dtype=np.uint8)
    ids[np.arange(len(a_ids)) + np.repeat(b_cut - nb, na)] = a_ids
    ids[np.arange(len(b_ids)) + np.repeat(a_cut, nb)] = b_ids
    mark[a_cut + b_cut - nb - 1] = ord("|")
    mark[a_cut + b_cut - 1] = ord(";")
    shown = DIGITS[ids]
    shown[:, 5] = mark
    return shown[SHOWN[ids]], np.cumsum(WIDTH[ids])[a_cut + b_cut - 1]


def squeeze(numbers: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending numbers and how often each occurs, packed."""
    values = np.concatenate([np.diff(numbers, prepend=0), times - 1])
    small = np.minimum(values, 255).astype(np.uint8)
    return zstandard.compress(np.uint32(len(numbers)).tobytes() + small.tobytes() + values[values >= 255].astype("<u4").tobytes(), 1)


def unsqueeze(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = zstandard.decompress(data)
    n = int(np.frombuffer(data, dtype="<u4", count=1)[0])
    values = np.frombuffer(data, dtype=np.uint8, count=2 * n, offset=4).astype(np.int64)
    values[values == 255] = np.frombuffer(data, dtype="<u4", offset=4 + 2 * n)
    return np.cumsum(values[:n]), values[n:] + 1


class Aligner:
    """Both vocabularies, and the alignment of runs of texts."""

    def __init__(self, definition: str, model: bytes) -> None:
        self.first, self.a_bytes = first_encoder(definition)
        self.second, self.b_bytes = second_encoder(model)
        self.a_size, self.b_size = (np.array([len(x) for x in parts]) for parts in (self.a_bytes, self.b_bytes))

    def tokens(self, text: str | None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides for each piece of space and text; none if the bytes of either differ from it.

        Long texts come in pieces that begin at a space between letters, where either side begins a token.
        """
        found = []
        for piece in bpe.pieces(" " + text) if text else ():
            data, a, b = piece.encode(), self.first(piece), self.second(piece[1:])
            if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
                return []
            found.append((np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)))
        return found

    def run(self, pieces: list[tuple[np.ndarray, np.ndarray]]):
        """Ids, ends and cuts of pieces that lie one behind the other, and the numbers of tokens up to each."""
        a_ids, b_ids = (np.concatenate(x) for x in zip(*pieces))
        a, b = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        a_to, b_to = (np.cumsum([len(x) for x in side]) for side in zip(*pieces))
        return a_ids, b_ids, a, b, a_to, b_to, *common_ends(a, b, a_to, b_to)

    def groups(self, text: str | None) -> list[tuple[list[int], list[int]]]:
        """The groups of one text: ids of the first side, ids of the second."""
        if not (pieces := self.tokens(text)):
            return []
        a_ids, b_ids, _, _, _, _, a_cut, b_cut = self.run(pieces)
        halves = (np.split(ids, cut[:-1]) for ids, cut in ((a_ids, a_cut), (b_ids, b_cut)))
        return [(x.tolist(), y.tolist()) for x, y in zip(*halves)]


class Packet:
    """Documents gathered until their pairs are counted together."""

    def __init__(self, aligner: Aligner) -> None:
        self.aligner, self.rows, self.waiting, self.size, self.held = aligner, [], [], 0, 0
        self.keys, self.owners = [], []

    def add(self, doc, text: str | None) -> None:
        pieces = self.aligner.tokens(text)
        self.rows.append([doc, sum(len(a) for a, _ in pieces), sum(len(b) for _, b in pieces), 0, 0, hashlib.sha256(), 0])
        for piece in pieces:
            self.waiting.append((len(self.rows) - 1, piece))
            self.held += int(self.aligner.a_size[piece[0]].sum())
            if self.held >= RUN_BYTES:
                self.align()

    def align(self) -> None:
        if not self.waiting:
            return
        owner = np.array([x for x, _ in self.waiting])
        a_ids, b_ids, a, b, a_to, b_to, a_cut, b_cut = self.aligner.run([x for _, x in self.waiting])
        text, ends = groups_text(a_ids, b_ids, a_cut, b_cut)
        text = text.tobytes()
        last = np.searchsorted(a_cut, a_to)
        x, y = links(a, b)
        linked = np.searchsorted(x, a_to - 1, "right")
        at = count = group = 0
        for row, end, many, to in zip(owner, ends[last].tolist(), linked.tolist(), last.tolist()):
            mine = self.rows[row]
            mine[3] += to + 1 - group
            mine[4] += many - count
            mine[5].update(b";" * (mine[6] > 0) + text[at : end - 1])
            mine[6] += 1
            at, count, group = end, many, to + 1
        self.keys.append(a_ids[x] << 16 | b_ids[y])
        self.owners.append(np.repeat(owner, np.diff(linked, prepend=0)))
        self.size += self.held
        self.waiting, self.held = [], 0

    def close(self, number: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Rows of the documents, then of the distinct pairs."""
        self.align()
        keys = np.concatenate(self.keys) if self.keys else np.zeros(0, dtype=np.int64)
        owners = np.concatenate(self.owners) if self.owners else np.zeros(0, dtype=np.int64)
        distinct, which, times = np.unique(keys, return_inverse=True, return_counts=True)
        own, many = np.unique(owners << 32 | which, return_counts=True)
        bounds = np.searchsorted(own >> 32, np.arange(len(self.rows) + 1))
        own &= 0xFFFFFFFF
        for at in range(0, len(self.rows), 1000):
            rows = self.rows[at : at + 1000]
            pairs = [squeeze(own[i:j], many[i:j]) for i, j in zip(bounds[at : at + len(rows)], bounds[at + 1 :])]
            doc, a, b, groups, linked, digest, pieces = zip(*rows)
            digest = [d.hexdigest() if p else "" for d, p in zip(digest, pieces)]
            none = [None] * len(rows)
            made = [[number] * len(rows), doc, a, b, groups, linked, digest, pairs, none, none]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(made, schema)], schema=schema)
        for at in range(0, len(distinct), 100_000):
            key, n = distinct[at : at + 100_000], times[at : at + 100_000]
            made = {"packet": np.full(len(key), number), "key": key, "n": n}
            yield pa.record_batch(
                [pa.array(made[f.name], f.type) if f.name in made else pa.nulls(len(key), f.type) for f in schema], schema=schema
            )


_LOADED: dict[tuple, Aligner] = {}


def aligner(definition: str, model: bytes) -> Aligner:
    """Both vocabularies, loaded once in each process."""
    key = (hashlib.sha256(definition.encode()).digest(), hashlib.sha256(model).digest())
    if key not in _LOADED:
        _LOADED[key] = Aligner(definition, model)
    return _LOADED[key]


def _totals(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The sums of one packet's documents over the totals of its pairs."""
    order = np.argsort(pairs["key"].to_numpy())
    total, best = (np.append(pairs[c].to_numpy()[order], 0) for c in ("total", "best"))
    n_best, count_sum = [], []
    for data in docs["pairs"].to_pylist():
        number, times = unsqueeze(data)
        n_best.append(int(times[total[number] == best[number]].sum()))
        count_sum.append(int((times * total[number]).sum()))
    docs = docs.drop_columns(["packet", "pairs"])
    return docs.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))


def align(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the sizes of its alignment, its digest, and sums over all its links.

    ``first`` is the file of a byte-level vocabulary, which reads space and text; ``second`` that of a piece model, which
    adds the space. ``n_best`` counts links whose pair is, in the whole corpus, the most frequent (or one of them) of
    its second id; ``count_sum`` adds the corpus counts of all links. A null or empty text, or one whose
    bytes either side doesn't give back, has no tokens: zeros and an empty digest. Rows with a null or
    repeated id are rows like others, and their links count; an empty table gives no rows; further columns
    are ignored. Texts are read whole.
    """
    spark = docs.sparkSession
    with open(first, encoding="utf-8") as file, open(second, "rb") as model:
        sent = spark.sparkContext.broadcast((file.read(), model.read()))  # their size doesn't depend on the data
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, schema, number = aligner(*sent.value), None, TaskContext.get().partitionId() << 32
        packet = Packet(tables)
        for batch in batches:
            schema = schema or pa.schema(
                [("packet", pa.int64()), ("doc_id", batch.schema.field(0).type), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                 ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("key", pa.int64()), ("n", pa.int64())]
            )
            for doc, text in zip(*batch.columns):
                packet.add(doc.as_py(), text.as_py())
                if packet.size >= PACKET_BYTES:
                    yield from packet.close(number, schema)
                    packet, number = Packet(tables), number + 1
        if packet.rows:
            yield from packet.close(number, schema)

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = materialize(texts.mapInArrow(run, PARTS.format(kind)), "alignment")
    pairs = parts.where("key is not null").select("packet", "key", "n")
    counts = materialize(pairs.groupBy("key").agg(F.sum("n").alias("total")), "pairs")
    token = (F.col("key") % (1 << 16)).alias("b")
    best = counts.groupBy(token).agg(F.max("total").alias("best"))
    known = materialize(counts.withColumn("b", token).join(best, "b").select("key", "total", "best"), "pairs", replaces=counts)
    asked = pairs.select(F.col("packet").alias("asks"), "key").join(known, "key")
    sizes = parts.where("pairs is not null").drop("key", "n")
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    summed = sizes.groupBy("packet").cogroup(asked.groupBy("asks")).applyInArrow(_totals, schema)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return summed.select(F.col("doc_id").alias(id_col), *names)


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_cross_tokenizer_alignment")
def op11_cross_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return align(table(spark, sf, "documents"), bpe.default_vocabulary(), default_model())
