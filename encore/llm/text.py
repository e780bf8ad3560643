"""Input columns, words and tokenizer files shared by the operators."""

from __future__ import annotations

import os
import re
import string

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value of the contracts: what separates words.  ``bytes.split()`` splits at the same six characters.
SPACE = r"[\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, so no other column can clash; a null text is the empty text."""
    return docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Cached(dict):
    """``make(key)`` remembered for up to ``limit`` keys, then begun anew: bounded memory, same results."""

    def __init__(self, make, limit: int = 1_000_000):
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Recent(dict):
    """``make(key)`` remembered for up to ``limit`` keys: when half of them are new, the older half that was not
    asked for since goes.  What is frequent stays, at less memory than :class:`Cached` needs for as few misses."""

    def __init__(self, make, limit: int):
        self.make, self.half, self.older = make, limit // 2, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def slices(batches, column: int, size: int = 1 << 22):
    """Arrow batches cut so that a slice holds about ``size`` bytes of the text column, or one longer text.

    What a task holds of words and arrays then depends on neither the batch
    size nor the number of long texts.
    """
    for b in batches:
        upto = np.cumsum(pc.binary_length(b.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, "right")))
            yield b.slice(at, end - at)
            at = end


_LOADED: dict = {}


def forget() -> None:
    """Empty what earlier operators have left in this worker; for operators that keep nothing themselves."""
    _LOADED.clear()


def per_worker(key, load):
    """``load()`` once per Python worker process and key; the worker keeps the last one only.

    A worker outlives an operator, so what one has remembered goes when the
    next one begins.
    """
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = load()
    return _LOADED[key]


#: Letters that no normal form joins to what stands beside them in a chunk of letters and marks.
_LETTERS = string.ascii_letters + "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))
#: A word of these, and marks after it; an apostrophe may begin a token with the letters before or after it.
_WORD = re.compile(f"([{_LETTERS}]+)([{re.escape(string.punctuation.replace("'", ""))}]*)")


def _letters(tok) -> dict:
    """What the tokenizer makes of each letter before its model, or nothing if it takes words of letters otherwise."""
    def pieces(w):
        return [p for p, _ in tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(w) if tok.normalizer else w)]

    if tok.pre_tokenizer is None:
        return {}
    made = {ord(c): "".join(pieces(c)) for c in _LETTERS}
    whole = [pieces(w) == [w.translate(made)] for w in (_LETTERS, _LETTERS[::-1])]
    return made if all(whole) else {}


def word_encoder(tokenizer_json: str):
    """bytes of a whitespace-free chunk -> its ids as little-endian uint32 bytes, remembered per worker.

    The tokenizers this serves (lower-casing, cutting at whitespace and between
    letters and punctuation) never merge across a chunk's ends, so a text's ids
    are its chunks' ids joined (tested against whole-text encoding).  A chunk of
    Latin letters goes to the tokenizer's model at once, marks after it go by
    themselves; any other chunk takes the whole way.
    """
    def load():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_str(tokenizer_json)
        letters, model = _letters(tok), tok.model

        def encode(chunk: bytes) -> bytes:
            text = chunk.decode()
            word = letters and _WORD.fullmatch(text)
            if not word:
                ids = tok.encode(text, add_special_tokens=False).ids
            elif word[2]:  # marks after a letter are tokens of their own
                return chunks[word[1].encode()] + chunks[word[2].encode()]
            else:
                ids = [t.id for t in model.tokenize(text.translate(letters))]
            return np.array(ids, "<u4").tobytes()
        chunks = Recent(encode, 700_000)
        return chunks
    return per_worker(("encoder", hash(tokenizer_json)), load)


def encode_ids(chunks: dict, text: bytes) -> bytes:
    """Ids of a whole text as little-endian uint32 bytes.

    The tokenizer lower-cases all but its special tokens, so A-Z are folded first where none can occur.
    """
    return b"".join([chunks[w] for w in (text if b"<|" in text else text.lower()).split()])


def read_file(path: str) -> str:
    """A tokenizer file, read on the driver and sent to the workers (a vocabulary's size is fixed)."""
    with open(path, encoding="utf-8") as f:
        return f.read()
