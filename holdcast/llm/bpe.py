"""Byte-level BPE by a backtracking encoder, and decoding by an offset table.

Encoding. A pre-token is encoded from left to right without replaying merges.
An Aho-Corasick automaton over the reversed tokens, run once over the reversed
bytes, gives for every position the longest token that begins there. The
encoder takes it if the pair with the token before is compatible, else the next
shorter prefix token, else it steps back over the token before. Two neighbours
are compatible if merging them pair by pair would leave the border between
them alone; answers are kept in a table. Positions that a failed try has left
are marked and not tried again, which keeps the work linear.

Decoding. Token bytes lie end to end in one blob with a table of offsets; a
list of ids is decoded by one gather.

The tokenizer file is read on the driver and its tables (fixed by the
vocabulary, a few MB) are broadcast. Frequent pre-tokens are remembered per
worker, within a fixed number of entries.

Defined cases: NULL text counts as empty: no ids, empty text. Strings of the
file's added tokens in a text become those tokens, as the tokenizers library
does. Every row, repeated ones too, gives one row. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdcast.llm.common import prepare, ranges, slices, text_bytes

#: Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same pattern for texts of common characters, whose classes can be spelled out.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
COMMON = rf"[\t\n\r\x20-\x7e{LETTERS}\u00a1\u00ab\u00bb\u00bf\u2013-\u201d\u2026\u20ac]*"
COMMON_PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\t\n\r 0-9{LETTERS}]+"
                  r"|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+")
MEMORY = 1 << 19       # pre-tokens that a worker remembers
REMEMBERED = 48        # characters of the longest of them, which bounds the memory's bytes
PAIRS = 1 << 20        # compatibility answers that a worker remembers


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Tokens as bytes, their merges, and the offset table."""

    def __init__(self, text: str):
        model = json.loads(text)
        of_letter = {c: b for b, c in enumerate(byte_letters())}
        raw = lambda s: bytes(of_letter[c] for c in s)
        self.added = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.token = {i: raw(s) for s, i in model["model"]["vocab"].items()}
        self.token |= {i: s.encode() for s, i in self.added.items()}
        ids = {v: i for i, v in self.token.items()}
        self.single = [ids.get(bytes([b]), -1) for b in range(256)]
        #: (left, right) -> (order of the merge, token it makes); token -> its (left, right, order).
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for order, pair in enumerate(model["model"]["merges"]):
            a, b = map(raw, pair if isinstance(pair, list) else pair.split(" "))
            made = ids[a + b]
            self.merge.setdefault((ids[a], ids[b]), (order, made))
            self.halves.setdefault(made, (ids[a], ids[b], order))
        size = max(self.token) + 1
        lengths = np.array([len(self.token.get(i, b"")) for i in range(size)], dtype=np.int64)
        self.offsets = np.r_[0, np.cumsum(lengths)]
        self.blob = np.frombuffer(b"".join(self.token.get(i, b"") for i in range(size)), np.uint8)

    def replay(self, data: bytes) -> list[int]:
        """Plain BPE: the first possible merge again and again. For the tables and tests."""
        ids = [self.single[b] for b in data]
        while len(ids) > 1:
            best = min((self.merge.get(p, (len(self.merge), 0))[0], k) for k, p in enumerate(zip(ids, ids[1:])))
            if best[0] == len(self.merge):
                break
            # Every occurrence of this merge, from the left.
            pair, out, k = (ids[best[1]], ids[best[1] + 1]), [], 0
            while k < len(ids):
                if k + 1 < len(ids) and (ids[k], ids[k + 1]) == pair:
                    out.append(self.merge[pair][1])
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        return ids


class Encoder:
    """Encodes pre-tokens and whole texts with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.added = sorted(vocabulary.added, key=len, reverse=True)
        self.size = np.diff(vocabulary.offsets).tolist()
        self.decimal = [b"%d" % i for i in range(len(self.size))]
        self.shorter = [-1] * len(self.size)    # a token's longest proper prefix that is a token
        self.whole: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton()
        for i, data in sorted(vocabulary.token.items(), key=lambda x: len(x[1])):
            if i in vocabulary.added.values() or not self._made_by_merges(i):
                continue
            self.whole[data] = i
            self.automaton.add_word(data[::-1].decode("latin-1"), i)
            self.shorter[i] = next((self.whole[data[:n]] for n in range(len(data) - 1, 0, -1)
                                    if data[:n] in self.whole), -1)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memory: dict[str, bytes] = {}
        self.patterns = regex.compile(PATTERN), re.compile(COMMON_PATTERN), re.compile(COMMON)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "patterns"} | {"pairs": {}, "memory": {}}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.patterns = regex.compile(PATTERN), re.compile(COMMON_PATTERN), re.compile(COMMON)

    def _made_by_merges(self, token: int) -> bool:
        """Whether merging a token's own bytes gives the token."""
        halves = self.v.halves.get(token)
        if halves is None:
            return len(self.v.token[token]) == 1
        return all(self._made_by_merges(h) for h in halves[:2]) and self.v.replay(self.v.token[token]) == [token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge ever reaches across the border of two neighbours.

        Undoes the merges of both tokens from the last one back. At each moment
        the two pieces at the border stand side by side; they would have been
        joined if their merge comes before the next merge on either side takes
        one of them away (on the left side it must come strictly first, since
        of equal merges the left one happens first).
        """
        answer = self.pairs.get((left, right))
        if answer is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            answer = self.pairs[left, right] = self._border_holds(left, right)
        return answer

    def _border_holds(self, left: int, right: int) -> bool:
        halves, merge, never = self.v.halves, self.v.merge, len(self.v.merge)
        # When each side's border piece is swallowed by its own token: not within the tokens as they are.
        until_left = until_right = never
        a, b = left, right
        while True:
            join = merge.get((a, b))
            if join is not None and join[0] < until_left and join[0] <= until_right:
                # Equal to the right side's merge: the border pair lies further left, so it goes first.
                return False
            from_left, from_right = halves.get(a), halves.get(b)
            if from_left is None and from_right is None:
                return True
            # Go back before the later of the two merges that made the pieces.
            if from_right is None or (from_left is not None and from_left[2] >= from_right[2]):
                a, until_left = from_left[1], from_left[2]
                if from_right is not None and from_right[2] == until_left:
                    b, until_right = from_right[0], from_right[2]
            else:
                b, until_right = from_right[0], from_right[2]

    def word(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        token = self.whole.get(data)
        if token is not None:
            return [token]
        n = len(data)
        # Matches that end at one place come longest first, so in reverse the longest is the last one put.
        longest = dict(reversed(list(self.automaton.iter(data[::-1].decode("latin-1")))))
        size, shorter, pairs = self.size, self.shorter, self.pairs
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token, before = 0, longest[n - 1], -1
        while at < n:
            while token >= 0:
                if not dead[at + size[token]]:
                    if before < 0:
                        break
                    fits = pairs.get((before, token))
                    if fits or fits is None and self.compatible(before, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += size[token]
                before = token
                token = longest.get(n - 1 - at, -1)
            else:
                dead[at] = 1
                token = out.pop()
                at -= size[token]
                token = shorter[token]
                before = out[-1] if out else -1
        return out

    def _pre_tokens(self, text: str) -> list[str]:
        full, common, plain = self.patterns
        return (common if plain.fullmatch(text) else full).findall(text)

    def _learn(self, word: str) -> bytes:
        ids = np.array(self.word(word.encode()), np.uint32).tobytes()
        if len(word) <= REMEMBERED:
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            self.memory[word] = ids
        return ids

    def _piece(self, text: str) -> bytes:
        words = self._pre_tokens(text)
        found = list(map(self.memory.get, words))
        if None in found:
            get, learn = self.memory.get, self._learn
            found = [ids if ids is not None else get(w) or learn(w) for ids, w in zip(found, words)]
        return b"".join(found)

    def encode(self, text: str) -> np.ndarray:
        """uint32 ids of a whole text."""
        if not any(s in text for s in self.added):
            return np.frombuffer(self._piece(text), np.uint32)
        out, at = [], 0
        for special in re.finditer("|".join(map(re.escape, self.added)), text):
            out += [self._piece(text[at:special.start()]),
                    np.uint32(self.v.added[special.group()]).tobytes()]
            at = special.end()
        return np.frombuffer(b"".join([*out, self._piece(text[at:])]), np.uint32)


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    """Bytes of a list of ids: one gather from the blob."""
    ids = ids.astype(np.int64)
    begin = vocabulary.offsets[ids]
    return vocabulary.blob[ranges(begin, vocabulary.offsets[ids + 1] - begin)].tobytes()


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The tables of a tokenizer file, built once on the driver."""
    with open(path, encoding="utf-8") as f:
        return Encoder(Vocabulary(f.read()))


def _over_texts(docs: DataFrame, path: str | None, make, schema: str) -> DataFrame:
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(encoder(path or tokenizer_path()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in slices(batches, 1):
            yield make(shared.value, rows)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text")).mapInArrow(run, schema)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids: the token ids of every text."""
    def make(encoder: Encoder, rows: pa.RecordBatch) -> pa.RecordBatch:
        out = [encoder.encode(text).astype(np.int32) for text in rows.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(out, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return _over_texts(docs, path, make, "doc_id bigint, ids array<int>")


def op7_bpe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    def make(encoder: Encoder, rows: pa.RecordBatch) -> pa.RecordBatch:
        counts, id_sums, text_sums = [], [], []
        for text in rows.column(1).to_pylist():
            ids = encoder.encode(text)
            counts.append(len(ids))
            id_sums.append(hashlib.sha256(b",".join(map(encoder.decimal.__getitem__, ids.tolist()))).hexdigest())
            # As the library does: bytes that are not UTF-8 become replacement characters.
            text_sums.append(hashlib.sha256(
                decode(encoder.v, ids).decode("utf-8", "replace").encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _over_texts(docs, path, make,
                       "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
