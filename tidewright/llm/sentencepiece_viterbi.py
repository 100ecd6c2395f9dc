"""SentencePiece encoding and decoding by an Aho-Corasick automaton and a single-pass Viterbi.

A model file gives pieces with scores. All pieces sit in one Aho-Corasick automaton; one pass over the text follows its
output links at each position, and each piece that ends there relaxes the best score of the position. A character that no
piece ends with falls back to its UTF-8 bytes. The result is the segmentation with the highest sum of scores, which is what the
sentencepiece library gives for the same pieces as a unigram model (a test compares both).

No piece of a model that splits by white space has a space mark after another character, and few have punctuation after
letters. Where no piece crosses, the Viterbi falls into independent stretches, and a stretch's result is kept in a cache of
bounded size. A model whose pieces cross the places before space marks is run over whole texts.

Nulls and empty texts give no ids. Equal scores: the longer last piece wins. Long texts are encoded whole. Repeated rows give
equal rows; columns beside doc_id and text are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import re
import string
import struct
import zlib

from pyspark.sql import DataFrame

from .common import TwoGenerations, map_rows, whole_text

MARK = "▁"
#: Words whose ids a task keeps.
CACHE = 400_000
_FLOOR = float("-inf")
#: A character by itself: length, score and piece.
_NONE = (1, 0.0, -1)


class Automaton:
    """Aho-Corasick over pieces. outputs: per state all pieces that end there, longest first, output links followed."""

    def __init__(self, pieces: list[tuple[str, tuple[int, float, int]]]) -> None:
        self.steps: list[dict[str, int]] = [{}]
        self.fails, self.outputs = [0], [()]
        for text, found in pieces:
            state = 0
            for char in text:
                following = self.steps[state].get(char)
                if following is None:
                    following = self.steps[state][char] = len(self.steps)
                    self.steps.append({})
                    self.fails.append(0)
                    self.outputs.append(())
                state = following
            self.outputs[state] = (found,)
        level = list(self.steps[0].values())
        while level:
            deeper = []
            for state in level:
                for char, child in self.steps[state].items():
                    self.fails[child] = self.follow(self.fails[state], char)
                    deeper.append(child)
                # states nearer to the root are complete by now
                self.outputs[state] += self.outputs[self.fails[state]]
            level = deeper
        self.known = [dict(step) for step in self.steps]

    def follow(self, state: int, char: str) -> int:
        """The state after a character, by the failure links."""
        while (following := self.steps[state].get(char)) is None:
            if not state:
                return 0
            state = self.fails[state]
        return following

    def learn(self, state: int, char: str) -> int:
        """As follow; a step that doesn't lead to the root is remembered, of which there are as many as trie edges per state met."""
        if following := self.follow(state, char):
            self.known[state][char] = following
        return following


class Pieces:
    """A model's pieces, with an automaton over the normal ones."""

    def __init__(self, pieces: list[tuple[str, float, str]], dummy_prefix: bool = True) -> None:
        """pieces: (text, score, kind), the id is the place; kind: normal, byte, unknown or control."""
        self.pieces, self.dummy_prefix = pieces, dummy_prefix
        self.kinds = [kind for _, _, kind in pieces]
        words = []
        self.byte_ids: dict[int, int] = {}
        self.unknown = 0
        lowest = 0.0
        for i, (text, score, kind) in enumerate(pieces):
            if kind == "normal" and text:
                words.append((text, (len(text), score, i)))
                lowest = min(lowest, score)
            elif kind == "byte":
                self.byte_ids[int(text[3:5], 16)] = i
            elif kind == "unknown":
                self.unknown = i
        self.automaton = Automaton(words)
        #: Fixed by the library: an unknown character costs 10 more than the worst piece.
        self.fallback_score = lowest - 10.0
        self.singles = {text for text, _, kind in pieces if kind == "normal" and len(text) == 1}
        self.words = self._splitter([text for text, _, kind in pieces if kind == "normal"])
        self.cache = TwoGenerations(CACHE)
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.texts = [text if kind == "normal" else " ⁇ " if kind == "unknown" else "" for text, _, kind in pieces]
        self.plain = set(range(len(pieces))).difference(self.byte_of)

    @staticmethod
    def _splitter(texts: list[str]) -> re.Pattern | None:
        """A pattern of the stretches that no piece crosses the ends of; None if pieces cross the places before space marks.

        A stretch begins at a space mark after another character, and, after a character that is neither mark nor ASCII
        punctuation, at punctuation that follows none such within any piece.
        """
        pairs = {text[i : i + 2] for text in texts for i in range(len(text) - 1)}
        if any(b == MARK != a for a, b in pairs):
            return None
        inner = {b for a, b in pairs if b in string.punctuation and a not in string.punctuation and a != MARK}
        marks, tied = re.escape(string.punctuation), re.escape("".join(sorted(inner)))
        more = f"(?:[{tied}][{marks}]*)?" if tied else ""
        return re.compile(f"{MARK}*[{marks}]*(?:[^{MARK}{marks}]+{more})*")

    @classmethod
    def load(cls, path: str) -> Pieces:
        return _load(path)

    def viterbi(self, text: str) -> tuple[int, ...]:
        """The ids of the best segmentation of a normalised text."""
        if not self.singles.issuperset(text):
            return self._viterbi_plain(text)
        known, outputs = self.automaton.known, self.automaton.outputs
        best, back, state, end = [0.0], [_NONE], 0, 0
        for char in text:
            following = known[state].get(char)
            state = self.automaton.learn(state, char) if following is None else following
            end += 1
            top, via = _FLOOR, _NONE
            for found in outputs[state]:  # longest first: at equal scores the longer piece stays
                if (value := best[end - found[0]] + found[1]) > top:
                    top, via = value, found
            best.append(top)
            back.append(via)
        return self._trace(text, back)

    def _viterbi_plain(self, text: str) -> tuple[int, ...]:
        """As viterbi, for texts with characters that are no pieces: a fallback competes after the pieces that end there."""
        known, outputs = self.automaton.known, self.automaton.outputs
        best, back, state = [0.0], [_NONE], 0
        for end, char in enumerate(text, 1):
            following = known[state].get(char)
            state = self.automaton.learn(state, char) if following is None else following
            top, via = _FLOOR, _NONE
            for found in outputs[state]:
                if (value := best[end - found[0]] + found[1]) > top:
                    top, via = value, found
            if char not in self.singles and (value := best[end - 1] + self.fallback_score) > top:
                top, via = value, _NONE
            best.append(top)
            back.append(via)
        return self._trace(text, back)

    def _trace(self, text: str, back: list[tuple[int, float, int]]) -> tuple[int, ...]:
        out: list[int] = []
        end = len(text)
        while end:
            length, _, piece = back[end]
            if piece >= 0:
                out.append(piece)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in reversed(text[end - 1].encode("utf-8", "surrogatepass")))
            elif not out or out[-1] != self.unknown:  # neighbours that are unknown count as one
                out.append(self.unknown)
            end -= length
        out.reverse()
        return tuple(out)

    def normalise(self, text: str) -> str:
        return (MARK if self.dummy_prefix and text else "") + text.replace(" ", MARK)

    def encode(self, text: str) -> list[int]:
        text = self.normalise(text)
        if self.words is None:
            return list(self.viterbi(text))
        out: list[int] = []
        cache = self.cache
        for word in self.words.findall(text):
            ids = cache.new.get(word) or cache.get(word)
            if ids is None:
                ids = self.viterbi(word)
                if len(word) < 64:
                    cache.put(word, ids)
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids; runs of byte pieces are read as UTF-8."""
        if self.plain.issuperset(ids):
            text = "".join(map(self.texts.__getitem__, ids))
        else:
            text = "".join(self._with_bytes(ids))
        if self.dummy_prefix and text.startswith(MARK):
            text = text[1:]
        return text.replace(MARK, " ")

    def _with_bytes(self, ids: list[int]) -> list[str]:
        parts: list[str] = []
        raw = bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                raw.append(b)
                continue
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw.clear()
            parts.append(self.texts[i])
        if raw:
            parts.append(raw.decode("utf-8", "replace"))
        return parts


@functools.lru_cache(maxsize=2)
def _load(path: str) -> Pieces:
    import sentencepiece

    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    rules = proto.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or any(p.type == 4 for p in proto.pieces):
        raise ValueError("models with normaliser rules, removal of white space or user-defined pieces aren't supported")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: "unknown" if model.is_unknown(i) else "control" if model.is_control(i) else "byte" if model.is_byte(i) else "unused" if model.is_unused(i) else "normal"
    return Pieces([(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())], dummy_prefix=model.encode("a", out_type=str)[0].startswith(MARK))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ids (array<int>) of each whole text by the pieces of the model file, a path that every executor has."""

    def make():
        pieces = Pieces.load(model)
        return lambda row: [(row["doc_id"], pieces.encode(row["text"]))]

    return map_rows(docs.select("doc_id", whole_text().alias("text")), make, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of (doc_id, ids). Null ids give an empty text."""

    def make():
        pieces = Pieces.load(model)
        return lambda row: [(row["doc_id"], pieces.decode(row["ids"] or []))]

    return map_rows(encoded.select("doc_id", "ids"), make, "doc_id long, text string")


def encode_digests(docs: DataFrame, model: str) -> DataFrame:
    """Per document what its ids amount to, and whether decoding them gives the text back."""

    def make():
        pieces = Pieces.load(model)

        def one(row):
            ids = pieces.encode(row["text"])
            packed = struct.pack(f"<{len(ids)}I", *ids)
            n_bytes = 0 if pieces.plain.issuperset(ids) else sum(map(pieces.byte_of.__contains__, ids))
            return [(row["doc_id"], len(ids), n_bytes, zlib.crc32(packed), pieces.decode(ids) == row["text"])]

        return one

    return map_rows(docs.select("doc_id", whole_text().alias("text")), make, "doc_id long, n_ids long, n_byte_ids long, ids_crc32 long, round_trip boolean")
