"""Token counts of whole texts, without ever sending token ids back to Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skyframe.llm.common import batch_of, schema_of

#: A piece of text longer than this is cut where no token can span the cut.
PIECE_CHARS = 32_768
#: Texts are encoded together until they hold about this many characters.
BATCH_CHARS = 1 << 20

MARK = "▁"


def can_cut(processor) -> bool:
    """Whether encoding a text cut before a space equals encoding it whole.

    That holds when no vocabulary entry has a word mark after another character, and when the
    processor itself puts the mark that the removed space stood for.
    """
    entries = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    if any(MARK in entry.lstrip(MARK) for entry in entries):
        return False
    joined = [("x y", "x", "y"), ("x  y", "x", " y"), ("x\n y", "x\n", "y")]
    return all(processor.encode(a) == processor.encode(b) + processor.encode(c) for a, b, c in joined)


def cut_text(text: str, size: int) -> Iterator[str]:
    """Cut at single spaces that follow other text, the space itself left out.

    A text without such a space for long goes on to the next one, or to its end.
    """
    start = 0
    while len(text) - start > size:
        at = start + size
        while (at := text.find(" ", at)) >= 0 and (at + 1 >= len(text) or text[at - 1] in " " + MARK):
            at += 1
        if at < 0:
            break
        yield text[start:at]
        start = at + 1
    yield text[start:]


def token_counts(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, n_bytes, n_tokens`` for each row of ``docs``, as sentencepiece encodes its whole text.

    ``model`` is a model file that every executor can read. Rows stay where they are: no shuffle.
    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids are counted as
    they are; other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(id_col, text_col)
    kept = docs.select(id_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        size = PIECE_CHARS if can_cut(processor) else 1 << 62
        for batch in batches:
            column = batch.column(1)
            tokens = np.zeros(len(column), np.int64)
            octets = np.zeros(len(column), np.int64)
            owners: list[int] = []
            pieces: list[str] = []
            held = 0

            def encode() -> None:
                lengths = np.fromiter(map(len, processor.encode(pieces, num_threads=1)), np.int64, len(pieces))
                np.add.at(tokens, owners, lengths)

            for i, scalar in enumerate(column):
                text = scalar.as_py() or ""
                octets[i] = len(text.encode())
                for piece in cut_text(text, size):
                    owners.append(i)
                    pieces.append(piece)
                    held += len(piece)
                    if held >= BATCH_CHARS:
                        encode()
                        owners, pieces, held = [], [], 0
            if pieces:
                encode()
            yield batch_of(batch, [id_col], n_bytes=pa.array(octets), n_tokens=pa.array(tokens))

    return rows.mapInArrow(count, schema_of(kept, ("n_bytes", T.LongType()), ("n_tokens", T.LongType())))
