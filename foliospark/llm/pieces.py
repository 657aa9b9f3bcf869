"""SentencePiece BPE encoding and decoding by a table of last tokens.

The encoding of every prefix of a text has one last token.  Going through the
text, an automaton over the vocabulary gives the tokens that end at each
character, longest first; the last token of the prefix is the one that is
compatible with the last token of the prefix before it, which is looked up in
the table.  Two tokens are compatible if merging their joined text again gives
just these two.  Ids are then recovered from the end of the text backwards.

Texts are cut where no token of the vocabulary can span: before blanks, at line
breaks, and between letters and other characters.  A part that was seen before
is not encoded again.  Characters outside the vocabulary become bytes.

Null texts count as empty; an empty text has no id but the end id, if one is
asked for.  Repeated rows stay; a null id is kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Codes, arrow_loop, list_array, texts

BLANK = "▁"


class PieceModel:
    """Vocabulary, merge times and the automaton of one model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = model.id_to_piece(list(range(size)))
        self.end_id = model.eos_id()
        self.bytes_at = model.piece_to_id("<0x00>")
        normal = [i for i in range(size) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {names[i]: i for i in normal}
        self.names = names
        self.characters = {n for n in self.ids if len(n) == 1}
        self.lengths = [len(n) for n in names]
        # A character is there from the start; other pieces form by falling score.
        self.time = {i: -1.0 if len(names[i]) == 1 else -model.get_score(i) for i in normal}
        self.automaton = ahocorasick.Automaton()
        for i in normal:
            self.automaton.add_word(names[i], (len(names[i]), i))
        self.automaton.make_automaton()
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.edges: dict[tuple[int, int], list] = {}
        self.parts = self.cuts()
        raw = [b""] * size
        for i in normal:
            raw[i] = names[i].replace(BLANK, " ").encode()
        for b in range(256):
            raw[self.bytes_at + b] = bytes([b])
        self.raw_sizes = np.array([len(r) for r in raw], np.int64)
        self.raw_starts = np.cumsum(self.raw_sizes) - self.raw_sizes
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.blank_first = np.array([r.startswith(b" ") for r in raw])
        self.silent = self.raw_sizes == 0

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge forms this one; None for a character."""
        if token not in self.halves:
            name = self.names[token]
            parts = list(name)
            while len(parts) > 2:
                at = min((self.time[t], i) for i in range(len(parts) - 1) if (t := self.ids.get(parts[i] + parts[i + 1])) is not None)[1]
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.halves[token] = (self.ids[parts[0]], self.ids[parts[1]]) if len(parts) == 2 else None
        return self.halves[token]

    def edge(self, token: int, side: int) -> list[tuple[str, float, float]]:
        """Texts that are at one edge of ``token`` while it forms: (text, from when, until when)."""
        key = (token, side)
        if key not in self.edges:
            out, until = [], float("inf")
            while True:
                out.append((self.names[token], self.time[token], until))
                halves = self.split(token)
                if halves is None:
                    break
                until = self.time[token]
                token = halves[side]
            self.edges[key] = out
        return self.edges[key]

    def fits(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes before the two tokens are complete.

        At equal times the merge further left comes first: the left token's own
        merge before one across the border, and that before the right token's own.
        """
        if len(self.compatible) > 400_000:
            self.compatible.clear()
        self.compatible[left, right] = fine = self._apart(self.edge(left, 1), self.edge(right, 0))
        return fine

    def _apart(self, left: list, right: list) -> bool:
        for a, left_from, left_until in left:
            for b, right_from, right_until in right:
                token = self.ids.get(a + b)
                if token is not None and self.time[token] < left_until and self.time[token] <= right_until and right_from < left_until and left_from <= right_until:
                    return False
        return True

    def cuts(self) -> re.Pattern:
        """Parts of texts such that no token reaches from one into the next."""
        letter = re.compile(r"[^\W\d_]")
        mixed = {c for name in self.ids for a, b in zip(name, name[1:]) if BLANK not in (a, b) and bool(letter.match(a)) != bool(letter.match(b)) for c in (a, b) if letter.match(c)}
        also = re.escape("".join(sorted(mixed)))
        return re.compile(rf"\n| *[^\W\d_{also}]+| *(?:[^\w \n]|[\d_{also}])+| +")

    def run(self, text: str) -> list[int]:
        """Ids of a text whose characters are all in the vocabulary."""
        last = [-1] * len(text)
        compatible, fits = self.compatible, self.fits
        for end, (size, token) in self.automaton.iter(text):
            if last[end] < 0:
                before = end - size
                if before < 0 or (last[before] >= 0 and (compatible[pair] if (pair := (last[before], token)) in compatible else fits(*pair))):
                    last[end] = token
        out, at = [], len(text) - 1
        while at >= 0:
            out.append(last[at])
            at -= self.lengths[last[at]]
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        """Ids of a text in which blanks are written as the blank mark."""
        known = self.characters
        if known.issuperset(text):
            return self.run(text)
        out, at = [], 0
        for i, c in enumerate(text):
            if c not in known:
                out += self.run(text[at:i]) if at < i else []
                out += [self.bytes_at + b for b in c.encode()]
                at = i + 1
        return out + (self.run(text[at:]) if at < len(text) else [])

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[str]:
        """Texts of consecutive id lists: one leading blank goes, and bytes outside UTF-8 become U+FFFD."""
        sizes = self.raw_sizes[ids]
        ends = np.cumsum(sizes)
        places = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.raw_starts[ids] - (ends - sizes), sizes)
        data = self.raw[places].tobytes()
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lengths)])].tolist()
        out = []
        for a, b in zip(cuts, cuts[1:]):
            # A line of bytes never begins with the byte 0x20 here: blanks are in the vocabulary.
            out.append(data[a + (data[a : a + 1] == b" ") : b].decode("utf-8", "replace"))
        return out


_models: dict[str, tuple[PieceModel, Codes]] = {}


def load(path: str) -> tuple[PieceModel, Codes]:
    """One model per Python worker."""
    if path not in _models:
        model = PieceModel(path)
        _models[path] = model, Codes(lambda parts: [model.encode(p.replace(" ", BLANK)) for p in parts], np.int32)
    return _models[path]


def encode_batch(path: str, batch: list[str], end: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in order and the number of ids of each; with ``end`` each text's end id follows."""
    model, codes = load(path)
    findall = model.parts.findall
    # The mark itself in a text is a blank, and a blank comes before every text that isn't empty.
    parts = [findall(" " + t.replace(BLANK, " ")) if t else [] for t in batch]
    ids, sizes = codes.expand(list(chain.from_iterable(parts)))
    at = np.concatenate([[0], np.cumsum(sizes)])
    ends = at[np.cumsum([len(ps) for ps in parts], dtype=np.int64)]
    lengths = np.diff(ends, prepend=0)
    if end:
        ids, lengths = np.insert(ids, ends, model.end_id).astype(np.int32), lengths + 1
    return ids, lengths


def encode_pieces(docs: DataFrame, path: str, end: bool = True) -> DataFrame:
    """doc_id and ids (array of int) of every text."""

    def make():
        def step(rows):
            ids, lengths = encode_batch(path, texts(rows.column("text")), end)
            return pa.RecordBatch.from_arrays([rows.column("doc_id"), list_array(ids, lengths, pa.int32())], ["doc_id", "ids"])

        return step

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(arrow_loop(make, caches=True), "doc_id long, ids array<int>")


def decode_pieces(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and text of rows with ids (null: none)."""

    def make():
        model, _ = load(path)

        def step(batch):
            lists = batch.column("ids")
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            found = model.decode(lists.flatten().to_numpy(zero_copy_only=False), lengths)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(found, pa.string())], ["doc_id", "ids", "text"])

        return step

    return rows.select("doc_id", "ids").mapInArrow(arrow_loop(make, caches=True), "doc_id long, ids array<int>, text string")
