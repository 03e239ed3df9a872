"""Token counts of whole texts, mostly without running the tokenizer's merges.

A BPE vocabulary in which no piece has a word mark after another character never merges across the
start of a word: the tokens of a text are those of its words, each with the mark (or marks) in front.
``prove`` checks that, and encodes every vocabulary string alone: those that come back as one token
form the whole-token table. A text's words that stand in the table count one each; all others are
merged once per distinct word of a batch.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

MARK = "▁"  # stands for a space in the vocabulary
KEPT = 400_000  # distinct words whose counts a task remembers before it starts anew


@dataclass(frozen=True)
class Proof:
    """The vocabulary strings that encode alone as one token, each with the mark in front."""

    whole: frozenset[str]


def load(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def prove(model: str) -> Proof:
    """Checks the vocabulary once, before any text is read. Its size bounds what tasks get."""
    sp = load(model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))]
    if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
        raise ValueError("a vocabulary string goes over the start of a word; words can't be counted apart")
    if sp.encode("a  b ", out_type=str) != [f"{MARK}a", MARK, f"{MARK}b", MARK] and sp.decode(sp.encode(" a  b ")) != " a  b ":
        raise ValueError("this model changes spaces; words can't be counted apart")
    marked = [p for p in pieces if p.startswith(MARK)]
    alone = sp.encode([p[1:].replace(MARK, " ") for p in marked])
    return Proof(frozenset(p for p, ids in zip(marked, alone, strict=True) if len(ids) == 1))


def counter(model: str, proof: Proof):
    """A function from a list of texts to their token counts."""
    sp, whole, words_of = load(model), proof.whole, re.compile(f"{MARK}+[^{MARK}]*").findall

    merged: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        if len(merged) > KEPT:
            merged.clear()
        split = [words_of(MARK + text.replace(" ", MARK)) if text else [] for text in texts]
        new = {w for words in split for w in words if w not in merged}
        merged.update(dict.fromkeys(new & whole, 1))
        rest = list(new - whole)
        # the encoder puts the first mark in front by itself
        for word, ids in zip(rest, sp.encode([w[1:] for w in rest], num_threads=1), strict=True):
            merged[word] = len(ids) if len(word) > 1 else 1
        size = merged.__getitem__
        return [sum(map(size, words)) for words in split]

    return count


def token_counts(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row for each row of ``docs``.

    Begin, end and added special tokens aren't counted; their strings inside a text are plain text.
    Null counts as empty, and empty has no tokens. Repeated rows stay; other columns are not read.
    """
    proof = prove(model)

    def work():
        count = counter(model, proof)

        def step(batch):
            texts = ["" if t is None else t for t in batch.column(2).to_pylist()]
            tokens = [n for at in range(0, len(texts), 512) for n in count(texts[at: at + 512])]
            return {"doc_id": batch.column(0), "n_bytes": batch.column(1), "n_tokens": np.array(tokens, np.int64),
                    "over_limit": pa.array([n > limit for n in tokens], pa.bool_())}
        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    return map_texts(rows, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", work)
