"""Public tokenizers that encode a text chunk by chunk and remember the chunks they have met.

A chunk ends where no token of the whole text can cross, so the ids of the chunks in a row are the
ids of the whole text; most words of a corpus are met again and again, and looking one up is far
cheaper than encoding it. The memory of a vocabulary is bounded: it is emptied when it holds
``KEEP_CHUNKS`` chunks, and chunks of more than ``KEEP_CHARS`` are encoded anew each time.

The places of the cuts, by kind of vocabulary:

* ``WordVocabulary``: at ASCII white space, which the tokenizer drops between words, and in ASCII and Latin letters at every word.
* ``ByteVocabulary``: a chunk is a word with the space before it, or a run of white space as far as
  its pattern's ``\\s+(?!\\S)`` takes it.
* ``PieceVocabulary``: before the first of several spaces and before a line feed, provided that no
  piece has a space after another character, or a line feed (checked when the model is loaded;
  otherwise texts are encoded whole).

The last two return None for a text whose tokens do not spell it out byte for byte.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from itertools import islice

import numpy as np
import sentencepiece
import tiktoken
from public_tokenizers import PATTERN
from tokenizers import Tokenizer

from lexicarium.llm.bpe import PIECE_CHARS, safe_pieces

KEEP_CHUNKS, KEEP_CHARS = 500_000, 48

#: What the byte-level pattern's \s matches: the characters with the property White_Space.
_WHITE = r"\t-\r " + "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_CHUNKS = re.compile(r"[^ \t-\r]+")
_WORDS = re.compile(rf" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]")
_PIECES = re.compile(r" +[^ \n]*|\n[^ \n]*")


class Memory:
    """chunk -> its ids as little-endian 32-bit integers (None: they do not spell it); chunks not met before are encoded together."""

    def __init__(self, encode_many: Callable[[list], list[bytes | None]]):
        self.known: dict = {}
        self.encode_many = encode_many

    def of(self, chunks: list) -> list[bytes | None]:
        missing = set(chunks).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > KEEP_CHUNKS:
                self.known.clear()
                missing = set(chunks)
            new = list(missing)
            self.known.update(zip(new, self.encode_many(new), strict=True))
        out = list(map(self.known.__getitem__, chunks))
        for chunk in missing:
            if len(chunk) > KEEP_CHARS:
                del self.known[chunk]
        return out


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()  # four bytes each, as on every machine that Spark runs on


#: How the word vocabulary's file says that it normalises and splits a text.
_WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters beyond ASCII that are one composed character each, with one lower-case form: Latin-1 and Latin Extended A and B without the dotted capital I.
_LATIN = "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x12F), (0x131, 0x24F)))
#: The same split of printable ASCII and these letters, before it is put in lower case; a chunk with any other character stays whole.
_KNOWN_WORDS = re.compile(rf"(?<![^ \t-\r])[!-~{_LATIN}]*+[^ -~\t-\r{_LATIN}][^ \t-\r]*|'(?:[sStTmMdD]|[rR][eE]|[vV][eE]|[lL][lL])|[a-zA-Z{_LATIN}]+|[0-9]|[^a-zA-Z0-9 \t-\r{_LATIN}]+")
_KNOWN_WORD = re.compile(rf"[!-~{_LATIN}]+")


class WordVocabulary:
    """A vocabulary whose tokenizer drops white space, from its JSON file.

    Words in printable ASCII and Latin letters are split off here, as the file says, so that the tokenizer's model sees a new word once, whatever
    stands around it; any other chunk, and a text that may hold a special token, goes through the whole tokenizer.
    """

    def __init__(self, file: bytes):
        tokenizer = Tokenizer.from_buffer(file)
        tokenize = tokenizer.model.tokenize
        whole = lambda chunk: tokenizer.encode(chunk, add_special_tokens=False).ids
        self._chunks = Memory(lambda new: [_packed(whole(c)) for c in new])
        letters = {b: c for c, b in byte_letters().items()}  # the model sees bytes as letters
        self._words = Memory(lambda new: [_packed([t.id for t in tokenize(w.lower().encode().decode("latin-1").translate(letters))] if _KNOWN_WORD.fullmatch(w) else whole(w)) for w in new])
        self._known_split = self._splits_as_known(json.loads(file))

    @staticmethod
    def _splits_as_known(file: dict) -> bool:
        normalizers = [n["type"] for n in (file.get("normalizer") or {}).get("normalizers", [])]
        splits = (file.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        pattern = splits[0].get("pattern", {}).get("Regex")
        special = all("<|" in t["content"] for t in file.get("added_tokens", []))
        return special and normalizers == _WORD_NORMALIZERS and pattern == _WORD_PATTERN

    def ids(self, raw: bytes) -> np.ndarray:
        text = raw.decode("utf-8", "replace")
        plain = self._known_split and "<|" not in text
        return np.frombuffer(b"".join(self._words.of(_KNOWN_WORDS.findall(text)) if plain else self._chunks.of(_CHUNKS.findall(text))), "<i4")


class _Spelled:
    """What vocabularies with token bytes share: ``token_bytes`` and ``sizes`` by id, and ``ids``."""

    token_bytes: list[bytes]

    def _finish(self, encode_many: Callable[[list[str]], list[list[int]]]) -> None:
        self.sizes = np.array([len(b) for b in self.token_bytes], np.int64)

        def checked(chunks: list[str]) -> list[bytes | None]:
            return [_packed(ids) if self.spell(ids) == chunk.encode() else None for chunk, ids in zip(chunks, encode_many(chunks), strict=True)]

        self._memory = Memory(checked)

    def spell(self, ids) -> bytes:
        return b"".join([self.token_bytes[i] for i in ids])

    def _chunks(self, spaced: str) -> list[str]:
        raise NotImplementedError

    def _whole(self, spaced: str) -> list[int]:
        raise NotImplementedError

    def ids(self, text: str) -> np.ndarray | None:
        """Ids of a space and the text; None if the tokens' bytes differ from it."""
        spaced = " " + text
        chunks = self._memory.of(self._chunks(spaced))
        if text and None not in chunks:
            return np.frombuffer(b"".join(chunks), "<i4")
        ids = self._whole(spaced)  # a chunk is not spelled out (or there is no text): the whole decides
        return np.asarray(ids, "<i4") if self.spell(ids) == spaced.encode() else None


def byte_letters() -> dict[str, int]:
    """The letters in which byte-level vocabularies write bytes: printable Latin-1 as it is, the other bytes in order from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteVocabulary(_Spelled):
    """A byte-level BPE with GPT-2's pattern, from its JSON file; strings of special tokens inside texts are plain text."""

    def __init__(self, file: bytes):
        tokenizer = Tokenizer.from_buffer(file)
        tokenizer.encode_special_tokens = True
        letters = byte_letters()
        special = {t["id"]: t["content"] for t in json.loads(file).get("added_tokens", [])}
        names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
        self.token_bytes = [special[i].encode() if i in special else bytes(letters[c] for c in t) for i, t in enumerate(names)]
        self._encode = lambda text: [i for piece in ([text] if len(text) <= PIECE_CHARS else safe_pieces(text)) for i in tokenizer.encode(piece, add_special_tokens=False).ids]
        merges = [m if isinstance(m, list) else m.split(" ") for m in json.loads(file)["model"]["merges"]]
        made = [tokenizer.token_to_id("".join(m)) for m in merges]
        same_order = made == sorted(set(made), key=lambda i: (i is None, i)) and set(made).isdisjoint(tokenizer.token_to_id(c) for c in letters)
        ranks = {b: i for i, b in enumerate(self.token_bytes) if i not in special}
        # where ids rise with the merges they are ranks, and ASCII, which all pattern libraries class alike, takes the faster encoder
        fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if same_order else None
        self._finish(lambda chunks: [fast.encode_ordinary(c) if fast and c.isascii() and len(c) <= PIECE_CHARS else self._encode(c) for c in chunks])

    def _chunks(self, spaced: str) -> list[str]:
        return _WORDS.findall(spaced)

    def _whole(self, spaced: str) -> list[int]:
        return self._encode(spaced)


class PieceVocabulary(_Spelled):
    """A SentencePiece model that puts a space before each text; pieces in UTF-8, U+2581 as space, byte pieces as their byte."""

    def __init__(self, file: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=file)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.token_bytes = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self._model, space = model, model.piece_to_id("▁")
        plain = [n for i, n in enumerate(names) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self._cuts = not any("\n" in n or "▁" in n.lstrip("▁") for n in plain)

        def encode_many(chunks: list[str]) -> list[list[int]]:
            found = model.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)  # the model puts a leading space back
            for k, c in enumerate(chunks):
                if c == " ":
                    found[k] = [space]
                elif c[0] != " " and found[k][:1] == [space]:
                    found[k] = found[k][1:]  # a line feed gets no space of its own
            return found

        self._finish(encode_many)

    def _chunks(self, spaced: str) -> list[str]:
        return _PIECES.findall(spaced) if self._cuts else [spaced]

    def _whole(self, spaced: str) -> list[int]:
        return self._model.encode(spaced[1:])


@lru_cache(maxsize=4)
def load(kind: type, file: bytes):
    """A vocabulary of this worker process: read once, with one memory for all its tasks."""
    return kind(file)
