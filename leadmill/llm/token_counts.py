"""Token counts without encoding: most pre-tokens of a text are one token by themselves.

Before any text is read, every string of the vocabulary is put through the tokenizer's own merges. Those that
come out as exactly one token are proven whole: a pre-token that equals one of them counts as one, without merging. Only other
pre-tokens are merged, and what stands between two blanks is counted once a task and then looked up.

The shortcut needs pre-tokens that end at blanks. Whether a tokenizer has them is probed when its file is read; one that
carries blanks over to the next piece is cut before single blanks where its pieces end there too. Where neither holds, as in
sentencepiece models, the library counts the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_words import WordMemo, library
from .common import map_texts

PROBE = ("a", "Bc", "x1,", "déjà", "it's", "42", "...", "é")


def pieces_of(tok, text: str) -> list[str]:
    """The pre-tokens of a text without special tokens, as the model gets them."""
    if tok.normalizer is not None:
        text = tok.normalizer.normalize_str(text)
    return [text] if tok.pre_tokenizer is None else [piece for piece, _ in tok.pre_tokenizer.pre_tokenize_str(text)]


def whole_tokens(tok) -> frozenset[str]:
    """The pre-tokens that the merges of `tok` turn into exactly one token, proven one by one. A string of the vocabulary that
    ends a word is tried without its mark."""
    mark = tok.model.end_of_word_suffix or ""
    names = tok.get_vocab(with_added_tokens=False)
    tried = (name[: -len(mark)] if mark else name for name in names if name.endswith(mark))
    return frozenset(piece for piece in tried if piece and len(tok.model.tokenize(piece)) == 1)


class JsonCounter:
    """Counts of a BPE file of the tokenizers library, equal to len(encode(text, add_special_tokens=False))."""

    def __init__(self, path: str):
        self.tok = library(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.drops_blanks = self._same(lambda a, b: pieces_of(self.tok, f"{a} {b}"), lambda a, b: pieces_of(self.tok, a) + pieces_of(self.tok, b))
        self.before_blanks = self._same(lambda a, b: pieces_of(self.tok, f"{a} {b}"), lambda a, b: pieces_of(self.tok, a) + pieces_of(self.tok, f" {b}"))
        self.whole = whole_tokens(self.tok)
        self.merged: dict[str, int] = WordMemo(self._merge)
        self.words: dict[str, int] = WordMemo(self._word)
        self.after_blank: dict[str, int] = WordMemo(self._after_blank)

    @staticmethod
    def _same(left, right) -> bool:
        return all(left(a, b) == right(a, b) for a in PROBE for b in PROBE)

    def _merge(self, piece: str) -> int:
        return len(self.tok.model.tokenize(piece))

    def _word(self, word: str) -> int:
        if not word:
            return 0
        if any(s in word for s in self.special):
            return len(self.tok.encode(word, add_special_tokens=False).ids)
        return sum(1 if piece in self.whole else self.merged[piece] for piece in pieces_of(self.tok, word))

    def _after_blank(self, word: str) -> int | None:
        """Of a word with the blank before it; None where that blank may belong to a longer run of white space."""
        return None if not word or word[0].isspace() or word[-1].isspace() else self._word(f" {word}")

    def count(self, text: str) -> int:
        if self.drops_blanks:
            return sum(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))
        if self.before_blanks:
            first, *words = text.split(" ")
            counts = list(map(self.after_blank.__getitem__, words))
            if None not in counts and not (words and first and first[-1].isspace()):
                return self._word(first) + sum(counts)
        return len(self.tok.encode(text, add_special_tokens=False).ids)


class ModelCounter:
    """Counts of a sentencepiece model: whole texts, by the library."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def count(self, text: str) -> int:
        return len(self.model.encode(text, num_threads=1))


@lru_cache(maxsize=2)
def counter(path: str) -> JsonCounter | ModelCounter:
    return ModelCounter(path) if path.endswith(".model") else JsonCounter(path)


def count_tokens(docs: DataFrame, tokenizer_path: str, *, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (more tokens than `limit`).

    One narrow stage: no shuffle, and a lost executor costs only its own splits. A null text counts as empty: no bytes, no
    tokens. Rows are taken as they come: repeated rows are counted each, a null id stays null. Only the two named
    columns are read, so others may have any name. An empty table gives no rows. Whole texts are counted, one at a time.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(tokenizer_path)
        for batch in batches:
            out = pd.DataFrame({"id": batch["i"].astype("Int64").to_numpy(dtype=object, na_value=None), "n_bytes": batch["b"]})
            out["n_tokens"] = [c.count(t) if t else 0 for t in batch["t"]]
            yield out

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("i"), F.octet_length(text).cast("long").alias("b"), text.alias("t"))
    counted = map_texts(source, run, "id long, n_bytes long, n_tokens long")
    return counted.withColumnRenamed("id", id_col).withColumn("over_limit", F.col("n_tokens") > limit)
