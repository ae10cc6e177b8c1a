"""The per-segment transform: an interface without a network, a deterministic stand-in, and work assignment."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import partial
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.operators.ranks import positions


class SegmentTransform(Protocol):
    """Answers a prompt. A blank answer or an exception is a failure."""

    name: str

    def generate(self, system: str, user: str) -> tuple[str, dict[str, int]]: ...


class Stub:
    """A stand-in that needs no network: the text between marks, its tokens counted as characters."""

    def __init__(self, fail_on: str | None = None, name: str = "stub"):
        self.fail_on, self.name = fail_on, name

    def generate(self, system: str, user: str) -> tuple[str, dict[str, int]]:
        if self.fail_on and self.fail_on in user:
            raise RuntimeError("refused")
        out = f"[{self.name}] {user.strip()}"
        return out, {"input": len(user), "output": len(out), "thinking": 0}


# The codes of providers and their names.
PROVIDERS = {"oai": "openai", "gmn": "gemini", "vtx": "vertex"}
CLIENTS: dict[str, Callable[[], SegmentTransform]] = {code: partial(Stub, name=name) for code, name in PROVIDERS.items()}


def provider(code: str) -> SegmentTransform:
    """A new client of a provider's code in any case; unknown codes fail. Put a client's class into CLIENTS to use it."""
    make = CLIENTS.get(code.strip().lower())
    if make is None:
        raise ValueError(f"no provider {code}")
    return make()


def provider_of(code: Column) -> Column:
    """The provider's name of a code in any case; null for unknown codes."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in PROVIDERS.items() for x in kv]), F.lower(F.trim(code)))


def transform(df: DataFrame, client: SegmentTransform, system: str = "", text: str = "content", retries: int = 0, wait: float = 0.0, keep_failed: bool = True) -> DataFrame:
    """``df`` with the answer in ``text``, and ok, error, in_tokens, out_tokens, attempts.

    A row that fails keeps its text, or is left out without ``keep_failed``.
    Attempts are ``retries`` + 1, with doubling waits from ``wait`` seconds.
    Null text counts as empty. Filter before: nothing is pushed through.
    """
    at = df.columns.index(text)
    names = df.columns
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", ok boolean, error string, in_tokens long, out_tokens long, attempts int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(at).to_pylist():
                error, answer, usage, n = None, None, {}, 0
                for n in range(1, retries + 2):
                    try:
                        answer, usage = client.generate(system, f"\n\n{t or ''}")
                        if not answer.strip():
                            raise ValueError("blank answer")
                        error = None
                        break
                    except Exception as e:  # whatever a client raises is a failure of this row
                        error = str(e)
                        if wait and n <= retries:
                            time.sleep(wait * 2 ** (n - 1))
                rows.append((answer if error is None else t, error is None, error, usage.get("input", 0), usage.get("output", 0), n))
            cols = list(b.columns)
            cols[at] = pa.array([r[0] for r in rows], pa.string())
            out = pa.RecordBatch.from_arrays([*cols, *(pa.array([r[i] for r in rows], t) for i, t in zip(range(1, 6), (pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.int32())))], names=[*names, "ok", "error", "in_tokens", "out_tokens", "attempts"])
            yield out if keep_failed else out.filter(out.column(len(names)))

    return df.mapInArrow(run, ddl)


def stub_answer(c: Column, name: str = "stub") -> Column:
    """What Stub answers, as a column."""
    from inkloom.functions.text import WS

    return F.concat(F.lit(f"[{name}] "), F.regexp_replace(F.coalesce(c, F.lit("")), f"^[{WS}]+|[{WS}]+$", ""))


def round_robin(df: DataFrame, keys: int, group: list[str], order: list[str]) -> DataFrame:
    """With worker: the request's position in its group, modulo the number of keys."""
    return positions(df, group, order, "_n").withColumn("worker", F.pmod(F.col("_n") - 1, F.lit(keys))).drop("_n")


def transform_titles(segments: DataFrame, client: SegmentTransform, keys: list[str], system: str = "") -> DataFrame:
    """keys, chapter_key, title, ok: one answer for each chapter that has a title, the title itself where that fails.

    The work is done once for each chapter, then merged into its segments by
    reconcile.merge_titles; ``ok`` counts real answers, not fallbacks.
    """
    from inkloom.functions.text import title_answer
    from inkloom.operators.reshape import unique_chapters

    done = transform(unique_chapters(segments, keys), client, system, text="title")
    return done.select(*keys, "chapter_key", F.when(F.col("ok"), title_answer(F.col("title"))).otherwise(F.col("title")).alias("title"), "ok")
