"""BPE encoding and decoding with forced boundaries."""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.storage import mapped

# Words whose ids are remembered at a time in one Python process, and their longest length.
MEMO_WORDS = 200_000
MEMO_LENGTH = 64
# Bytes of ids that are decoded at a time.
DECODED = 4 << 20
# A pair that cannot be merged: after all that can.
NONE = (1 << 62, 0)

# The word pattern, the end mark and the white space of this kind of vocabulary.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"

# Code points that the vocabulary's library does not know as letters or numbers
# (they came after Unicode 16), capitals that it knows and this Python does not, and marks that
# neither move nor join in its composed form.
NEWER = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1"
    "\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee"
    "\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f"
    "\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6"
    "\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2"
    "\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed"
    "\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead"
    "\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB, 0xA7DC: 0x019B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
MARKS = (
    "\u07fd\u0898-\u089f\u08ca-\u08d3\u09fe\u0c3c\u0d3b-\u0d3c\u0eba\u1715\u1abf-\u1ace"
    "\u1df6-\u1dfa\ua82c\U00010d24-\U00010d27\U00010eab-\U00010eac\U00010efd-\U00010eff"
    "\U00010f46-\U00010f50\U00010f82-\U00010f85\U00011070\U0001133b\U0001145e"
    "\U00011839-\U0001183a\U00011930\U00011938\U0001193d-\U0001193e\U00011943\U000119e0"
    "\U00011a34\U00011a47\U00011a99\U00011d42\U00011d44-\U00011d45\U00011d97"
    "\U00011f41-\U00011f42\U00016ff0-\U00016ff1\U0001e08f\U0001e130-\U0001e136\U0001e2ae"
    "\U0001e2ec-\U0001e2ef\U0001e4ec-\U0001e4ef"
)

# Text of these characters alone is in composed form and has lower case by
# character within them; its letters and numbers, for the faster of the two regex engines.
LATIN = re.compile("[\t\n\r -~¡-įı-ȹȻ-Ƚȿ-\u02ff]*")
LATIN_WORD = re.compile(
    "'(?:[stmd]|re|ve|ll)|[a-zªµºß-öø-\u02c1\u02c6-\u02d1\u02e0-\u02e4\u02ec\u02ee]+|[0-9²³¹¼-¾]"
    "|[^\\sa-zªµºß-öø-\u02c1\u02c6-\u02d1\u02e0-\u02e4\u02ec\u02ee0-9²³¹¼-¾]+"
)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encodes words by their forced fragments."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocab: dict[str, int] = model["model"]["vocab"]
        added = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, number in (vocab | added).items():
            self.tokens[number] = token
        self.added = added
        self.mark = regex.compile("|".join(map(regex.escape, sorted(added)))) if added else None
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        # Bytes next to each other inside a token, and those that end a token which ends a word.
        self.inner = [bytearray(256) for _ in letters]
        self.final = [bytearray(256) for _ in letters]
        for token in vocab:
            if token in added:
                continue
            whole = [byte_of[c] for c in token.removesuffix(END)]
            pairs = list(zip(whole, whole[1:]))
            if token.endswith(END) and pairs:
                x, y = pairs.pop()
                self.final[x][y] = 1
            for x, y in pairs:
                self.inner[x][y] = 1
        self.letter = [vocab[c] for c in letters]
        self.last = [vocab[c + END] for c in letters]
        self.word = regex.compile(WORD)
        self.space = regex.compile(SPACE)
        self.marks = regex.compile(f"([{MARKS}])")
        self.newer = regex.compile(f"[{NEWER}{''.join(map(chr, LOWER))}]")
        known = f"(?![{NEWER}])"
        self.word_of_known = regex.compile(
            WORD.replace(r"[\p{L}]+", rf"(?:{known}\p{{L}})+")
            .replace(r"[\p{N}]", rf"{known}\p{{N}}")
            .replace(r"[^\s\p{L}\p{N}]+", rf"(?:[{NEWER}]|[^\s\p{{L}}\p{{N}}])+")
        )
        # Words by ids. A full memo is kept as the older one, so that frequent words stay known.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.names = pa.array(self.tokens, pa.string())

    def fragments(self, word: bytes) -> list[bytes]:
        """``word`` cut between all bytes that no token of the vocabulary holds together.

        The mark of a word's end belongs to its last byte, so a token that carries it can hold
        the last two bytes only, and only the others can hold two that come before.
        """
        parts, start, stop = [], 0, len(word) - 1
        for i in range(1, stop):
            if not self.inner[word[i - 1]][word[i]]:
                parts.append(word[start:i])
                start = i
        if stop and not self.final[word[stop - 1]][word[stop]]:
            parts.append(word[start:stop])
            start = stop
        parts.append(word[start:])
        return parts

    def _merge(self, fragment: bytes, ends: bool) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until no pair can be merged.

        The last byte of a fragment that ends a word starts as the symbol with the end mark.
        """
        ids = [self.letter[b] for b in fragment]
        if ends:
            ids[-1] = self.last[fragment[-1]]
        if len(ids) > 4 * MEMO_LENGTH:
            return self._merge_long(ids)
        merges = self.merges
        found = [merges.get(p, NONE) for p in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best is NONE:
                break
            i = found.index(best)
            ids[i : i + 2] = [best[1]]
            del found[i]
            if i:
                found[i - 1] = merges.get((ids[i - 1], ids[i]), NONE)
            if i < len(found):
                found[i] = merges.get((ids[i], ids[i + 1]), NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """As above for a long fragment, with a heap of pairs and links between symbols."""
        from heapq import heapify, heappop, heappush

        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(self.merges[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges]
        heapify(heap)
        while heap:
            _, i, (a, b) = heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.merges[a, b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] >= 0:
                    pair = (ids[left], ids[after[left]])
                    if pair in self.merges:
                        heappush(heap, (self.merges[pair][0], left, pair))
        return [x for x in ids if x >= 0]

    def _word(self, word: str) -> bytes:
        if (packed := self.older.get(word)) is None:
            parts = self.fragments(word.encode())
            ids = [x for part in parts[:-1] for x in self._merge(part, False)] + self._merge(parts[-1], True)
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= MEMO_LENGTH:
            if len(self.memo) >= MEMO_WORDS:
                self.memo, self.older = {}, self.memo
            self.memo[word] = packed
        return packed

    def words(self, text: str) -> list[str]:
        """Words of ``text``: composed, white space as one space, lower case by character."""
        if LATIN.fullmatch(text):
            return LATIN_WORD.findall(text.lower())
        if self.marks.search(text):
            text = "".join(unicodedata.normalize("NFC", part) for part in self.marks.split(text))
        else:
            text = unicodedata.normalize("NFC", text)
        # Lower case of a whole text would tell a sigma at the end of a word apart.
        text = self.space.sub(" ", text).replace("\u03a3", "\u03c3")
        if self.newer.search(text):
            return self.word_of_known.findall(text.translate(LOWER).lower())
        return self.word.findall(text.lower())

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.mark:
            return self._span(text)
        pieces: list[bytes] = []
        place = 0
        for found in self.mark.finditer(text):
            pieces.append(self._span(text[place : found.start()]))
            pieces.append(self.added[found[0]].to_bytes(4, "little"))
            place = found.end()
        pieces.append(self._span(text[place:]))
        return b"".join(pieces)

    def _span(self, text: str) -> bytes:
        words = self.words(text)
        known = list(map(self.memo.get, words))
        if None in known:
            # A word that comes again is encoded once, short or long.
            new = {word: self._word(word) for word, ids in dict(zip(words, known)).items() if ids is None}
            known = [ids or new[word] for word, ids in zip(words, known)]
        return b"".join(known)

    def decode(self, ids: list[bytes]) -> Iterator[str]:
        """Tokens of each text joined by one space: this vocabulary file names no decoder of
        its own."""
        i = 0
        while i < len(ids):
            j, size = i + 1, len(ids[i])
            while j < len(ids) and size + len(ids[j]) <= DECODED:
                size += len(ids[j])
                j += 1
            offsets = np.cumsum([0, *(len(x) // 4 for x in ids[i:j])])
            tokens = self.names.take(pa.array(np.frombuffer(b"".join(ids[i:j]), "<u4")))
            for text in pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), tokens), " "):
                yield text.as_py()
            i = j


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def _vocabulary(path: str | None) -> str:
    if path is None:
        import public_tokenizers

        return public_tokenizers.path("word_bpe_49k.json")
    return path


def encode(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Token ids of each text: doc_id, ids (little-endian unsigned 32-bit integers).

    Text is normalized and cut into words as the vocabulary file says. A word is cut again
    between any two bytes that are never next to each other inside a token: no merge can
    cross such a place, so fragments are encoded by themselves and their ids joined.

    ``path`` names the vocabulary file, which every executor must have; the default is the
    installed one. Null text counts as empty and gives no ids; repeated rows give one row
    each; other columns are not read.
    """
    path = _vocabulary(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            ids = [bpe.encode(t.as_py() or "") for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    return mapped(source, run, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Texts of token ids: doc_id, ids, text. Null ids count as none."""
    path = _vocabulary(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = list(bpe.decode([x.as_py() or b"" for x in batch.column(1)]))
            yield pa.record_batch(
                [*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
            )

    return mapped(encoded.select("doc_id", "ids"), run, "doc_id bigint, ids binary, text string")


def round_trip(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Digests of ``encode`` and ``decode``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Both steps run in one pass, and only the digests leave it. Cases are as in ``encode``.
    """
    path = _vocabulary(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            ids = [bpe.encode(text.as_py() or "") for text in batch.column(1)]
            sizes = [len(x) // 4 for x in ids]
            ids_sha = [hashlib.sha256(x).hexdigest() for x in ids]
            text_sha = [hashlib.sha256(text.encode()).hexdigest() for text in bpe.decode(ids)]
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    return mapped(source, run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
