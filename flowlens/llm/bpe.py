"""Byte-level BPE as a streaming transducer with bounded lookahead, and the way back.

A sequence of tokens is the encoding of its bytes exactly if every two neighbours are *stable*: no merge
across their border would come before the merges that build them. So the encoding of a prefix is the
encoding of a shorter prefix plus one token, and the transducer keeps only the last token of every prefix.
A token that ends after the current byte starts at most ``lookahead`` bytes back, ``lookahead`` being
computed from the merge list (its longest token). As soon as all prefixes inside that window have a common
start, the tokens of that start can't change any more and are emitted; what lies before is forgotten. Memory
doesn't grow with the text. All words pass through it; the tokens of short words are remembered for a while.

Decoding maps tokens to bytes and feeds them, block by block, to an incremental UTF-8 state machine.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.queries import query, table

#: How texts fall into words before merging (fixed values of this vocabulary's family).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|" \
        r"\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: The same for ASCII texts, in the faster engine.
ASCII_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
#: Texts are cut into words in pieces of so many characters; longer ones only where a word is longer.
PIECE = 1 << 16
SAFE_CUT = re.compile(r"(?<=[0-9A-Za-z.,]) (?=[0-9A-Za-z])")
#: The tokens of words up to so many characters are remembered, two generations of so many words.
REMEMBERED_LENGTH, REMEMBERED_WORDS = 64, 1 << 18
REMEMBERED_PAIRS = 1 << 19
#: The transducer's states after so many first bytes of a word are remembered, up to so many.
HEAD, REMEMBERED_HEADS = 5, 1 << 16
#: Bytes of a word reach the transducer in chunks of so many characters.
CHUNK = 1 << 12
DECODED_AT_ONCE = 1 << 14
OUTPUTS = {"ids": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Remembered(dict):
    """The tokens of words seen of late: of two generations, the older one is dropped when the younger is full."""

    def __init__(self, find: Callable[[str], Iterator[int]]) -> None:
        self.find, self.older = find, {}

    def __missing__(self, word: str) -> Iterable[int]:
        if len(word) > REMEMBERED_LENGTH:
            return self.find(word)
        found = self.older.get(word)
        if found is None:
            found = tuple(self.find(word))
        if len(self) >= REMEMBERED_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


def pieces(text: str) -> Iterator[str]:
    """The text in pieces of about ``PIECE`` that end between words, where single spaces allow it."""
    at = 0
    while len(text) - at > PIECE and (cut := SAFE_CUT.search(text, at + PIECE)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def words_of(text: str, pattern) -> Iterator[list[str]]:
    """The words of a text, in runs. A word is certain once two more follow it in the piece at hand."""
    at, size = 0, PIECE
    while at < len(text):
        found = pattern.findall(text[at : at + size] if at or size < len(text) else text)
        if at + size < len(text):
            # the end of a piece may cut a word, or the letters of 're or 'll from their apostrophe
            found = found[:-2]
        if found:
            yield found
            at, size = at + sum(map(len, found)), PIECE
        else:
            size *= 2


class Transducer:
    """The tables of one vocabulary, given as the JSON text of a tokenizer file."""

    def __init__(self, definition: str) -> None:
        given = json.loads(definition)
        names = byte_names()
        raw = lambda name: bytes(names[c] for c in name)
        vocab = given["model"]["vocab"]
        self.bytes_of: dict[int, bytes] = {i: raw(name) for name, i in vocab.items() if all(c in names for c in name)}
        self.special = {x["content"]: x["id"] for x in given.get("added_tokens", [])}
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        self.table = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        #: pair of tokens -> rank of its merge; token -> its two parts and the rank of the merge that makes it
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(given["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made = vocab[left + right]
            if made in self.parts:
                raise ValueError(f"two merges make {left + right!r}")
            self.rank[vocab[left], vocab[right]] = rank
            self.parts[made] = (vocab[left], vocab[right], rank)
        #: every beginning of a token -> the longest token that it ends with; token -> the next shorter one that it ends with
        of_bytes = {self.bytes_of[i]: i for i in chain(self.parts, (vocab[c] for c in names if c in vocab))}
        longest = lambda word, at: next((of_bytes[word[i:]] for i in range(at, len(word)) if word[i:] in of_bytes), -1)
        self.beginnings = {word[:to]: -1 for word in of_bytes for to in range(1, len(word) + 1)}
        for word in self.beginnings:
            self.beginnings[word] = longest(word, 0)
        self.shorter = [longest(word, 1) for word in self.table]
        self.sizes = [len(x) for x in self.table]
        self.lookahead = max(len(self.bytes_of[i]) for i in self.parts)
        self.words, self.ascii_words = regex.compile(WORDS), re.compile(ASCII_WORDS, re.ASCII)
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.decimal = [str(i) for i in range(len(self.table))]
        self.edges: tuple[dict, dict] = ({}, {})
        self.stable_pairs: dict[tuple[int, int], bool] = {}
        self.heads: dict[bytes, tuple[list[int], int]] = {}
        self.remembered = Remembered(self._word)

    def _spine(self, token: int, side: int) -> list[tuple[int, float, float]]:
        """The pieces at one edge of a token: each with the ranks at which it is made and used up."""
        found, used = [], float("inf")
        while token in self.parts:
            rank = self.parts[token][2]
            found.append((token, rank, used))
            token, used = self.parts[token][side], rank
        found.append((token, -1, used))
        return found

    def _apart(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart when their bytes are encoded together."""
        ends, starts = self.edges[1], self.edges[0]
        if left not in ends:
            ends[left] = self._spine(left, 1)
        if right not in starts:
            starts[right] = self._spine(right, 0)
        rank_of = self.rank.get
        for a, made_a, used_a in ends[left]:
            for b, made_b, used_b in starts[right]:
                rank = rank_of((a, b))
                # of equal merges the one further left comes first
                if rank is not None and made_a < used_b and made_b < used_a and rank < used_a and rank <= used_b:
                    return False
        return True

    def stable(self, left: int, right: int) -> bool:
        known = self.stable_pairs.get((left, right))
        if known is None:
            if len(self.stable_pairs) >= REMEMBERED_PAIRS:
                self.stable_pairs.clear()
            known = self.stable_pairs[left, right] = self._apart(left, right)
        return known

    def _extend(self, ends: list[int], window: bytes, start: int) -> int:
        """Append the last token of each further prefix of the window.

        From ``start`` on the bytes begin a token, and from no place before it; the new such place is returned. So
        tokens that end at the same byte are found in one step, the longest first.
        """
        begins, pairs, stable, sizes, shorter = self.beginnings.get, self.stable_pairs.get, self.stable, self.sizes, self.shorter
        for end in range(len(ends), len(window) + 1):
            while (token := begins(window[start:end])) is None:
                start += 1
            while (before := ends[end - sizes[token]]) >= 0 and not (
                known if (known := pairs((before, token))) is not None else stable(before, token)
            ):
                token = shorter[token]
            ends.append(token)
        return start

    def _begun(self, head: bytes) -> tuple[list[int], int]:
        """The state after the first bytes of a word, which many words share."""
        if head not in self.heads:
            if len(self.heads) >= REMEMBERED_HEADS:
                self.heads.clear()
            ends = [-1]
            self.heads[head] = ends, self._extend(ends, head, 0)
        ends, start = self.heads[head]
        return ends.copy(), start

    def stream(self, word: Iterable[bytes]) -> Iterator[int]:
        """The tokens of one word that comes in chunks of bytes, each as soon as it is certain."""
        # the last token of each prefix of the window; in front of the window lies what has been emitted
        ends, window, start = [-1], b"", 0
        for chunk in word:
            for at in range(0, len(chunk), self.lookahead):
                window += chunk[at : at + self.lookahead]
                if len(ends) == 1 and ends[0] < 0:
                    ends, start = self._begun(window[:HEAD])
                start = self._extend(ends, window, start)
                if len(ends) > 4 * self.lookahead and (keep := self._certain(ends)):
                    yield from self._back(ends, keep)
                    # no token is longer than the lookahead: a place in front of the border begins none that goes on
                    window, ends, start = window[keep:], ends[keep:], max(0, start - keep)
        yield from self._back(ends, len(ends) - 1)

    def _certain(self, ends: list[int]) -> int:
        """The last border that the encodings of all prefixes inside the lookahead share."""
        fronts = set(range(max(0, len(ends) - self.lookahead), len(ends)))
        while len(fronts) > 1:
            far = max(fronts)
            fronts.remove(far)
            fronts.add(far - len(self.bytes_of[ends[far]]))
        return fronts.pop()

    def _back(self, ends: list[int], end: int) -> list[int]:
        found = []
        while end > 0:
            found.append(ends[end])
            end -= len(self.bytes_of[ends[end]])
        return found[::-1]

    def _word(self, word: str) -> Iterator[int]:
        if len(word) <= CHUNK:
            return self.stream((word.encode(),))
        return self.stream(word[at : at + CHUNK].encode() for at in range(0, len(word), CHUNK))

    def encode(self, text: str) -> Iterator[int]:
        """The tokens of a text, in order; strings of special tokens become these tokens."""
        return self._marked(text) if self.specials.search(text) else self._plain(text)

    def _marked(self, text: str) -> Iterator[int]:
        at = 0
        for mark in self.specials.finditer(text):
            yield from self._plain(text[at : mark.start()])
            yield self.special[mark.group()]
            at = mark.end()
        yield from self._plain(text[at:])

    def _plain(self, text: str) -> Iterator[int]:
        runs = words_of(text, self.ascii_words if text.isascii() else self.words)
        return chain.from_iterable(map(self.remembered.__getitem__, chain.from_iterable(runs)))

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Pieces of text for tokens as they come; bytes that are no UTF-8 become U+FFFD."""
        ids, machine = iter(ids), codecs.getincrementaldecoder("utf-8")("replace")
        while block := list(islice(ids, DECODED_AT_ONCE)):
            yield machine.decode(b"".join(map(self.table.__getitem__, block)))
        yield machine.decode(b"", final=True)


_LOADED: dict[str, Transducer] = {}


def transducer(definition: str) -> Transducer:
    """The tables of a vocabulary, built once in each process."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Transducer(definition)
    return _LOADED[key]


def row_outputs(tables: Transducer, text: str | None, outputs: list[str]) -> list:
    """What ``outputs`` name, for one text. Tokens go by in blocks; only ``ids`` and ``decoded`` hold the whole."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    n, ids, decoded, of_ids, of_text = 0, [], [], hashlib.sha256(), hashlib.sha256()
    stream = tables.encode(text or "")
    while True:
        block = list(islice(stream, DECODED_AT_ONCE))
        if "ids" in outputs:
            ids += block
        if "ids_sha256" in outputs and block:
            of_ids.update((("," if n else "") + ",".join(map(tables.decimal.__getitem__, block))).encode())
        if "decoded" in outputs or "decoded_sha256" in outputs:
            piece = machine.decode(b"".join(map(tables.table.__getitem__, block)), final=not block)
            of_text.update(piece.encode())
            if "decoded" in outputs:
                decoded.append(piece)
        n += len(block)
        if not block:
            break
    found = {"ids": ids, "n_tokens": n, "ids_sha256": of_ids.hexdigest(), "decoded": "".join(decoded)}
    found["decoded_sha256"] = of_text.hexdigest()
    return [found[name] for name in outputs]


def _definition(spark: SparkSession, vocabulary: str):
    """The vocabulary file's text for the tasks; its size doesn't depend on the data."""
    with open(vocabulary, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(
    docs: DataFrame,
    vocabulary: str,
    outputs: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its id and the ``outputs``, any of ``OUTPUTS``.

    ``ids`` are the tokens of the whole text, ``decoded`` the text that they give back. A null or empty text
    has no tokens; a null id is kept; repeated rows are kept; an empty table gives no rows; further columns
    of ``docs`` are ignored. Needs no shuffle.
    """
    sent = _definition(docs.sparkSession, vocabulary)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = transducer(sent.value)
        types = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [row_outputs(tables, x.as_py(), outputs) for x in part.column(1)]
                made = [pa.array(column, types.get(name, pa.string())) for name, column in zip(outputs, zip(*rows))]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], [id_col, *outputs])

    schema = ", ".join([f"`{id_col}` {kind}", *(f"{name} {OUTPUTS[name]}" for name in outputs)])
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def decode(tokens: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``tokens``: its id and ``decoded``, the text of an array of tokens (null: empty)."""
    sent = _definition(tokens.sparkSession, vocabulary)
    kind = tokens.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = transducer(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = ["".join(tables.decode(x.as_py() or ())) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], [id_col, "decoded"])

    return tokens.select(id_col, F.col(ids_col).cast("array<int>")).mapInArrow(run, f"`{id_col}` {kind}, decoded string")


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf: str) -> DataFrame:
    outputs = ["n_tokens", "ids_sha256", "decoded_sha256"]
    return encode(table(spark, sf, "documents"), default_vocabulary(), outputs)
