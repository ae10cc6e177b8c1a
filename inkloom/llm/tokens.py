"""Token counts under the public tokenizers, whose folder is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkloom.runtime import spread

DEFAULT_FOLDER = "/opt/tokenizers"
DEFAULT_TOKENIZER = "byte_bpe_multi_50k.tiktoken"

# Fixed value: the pre-split pattern that belongs to the byte-level vocabularies.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoder(folder: str, name: str):
    """A function from a list of texts to their token counts."""
    path = f"{folder.rstrip('/')}/{name}"
    if name.endswith(".tiktoken"):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        e = tiktoken.Encoding(name, pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(e.encode_ordinary(t)) for t in texts]
    if name.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def token_counts(df: DataFrame, text: str, keep: list[str], folder: str = DEFAULT_FOLDER, name: str = DEFAULT_TOKENIZER) -> DataFrame:
    """``keep`` columns of ``df`` with ``n_tokens`` of ``text``; null and empty texts have 0 tokens."""
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)
        for b in batches:
            n = []
            for at in range(0, b.num_rows, 256):
                n += enc([t or "" for t in b.column(len(keep)).slice(at, 256).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(np.array(n, dtype=np.int64))], names=[*keep, "n_tokens"])

    return spread(df.select(*keep, text)).mapInArrow(count, f"{fields}, n_tokens long")
