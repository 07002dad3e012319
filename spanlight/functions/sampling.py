"""Repeatable sampling decisions from the event id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contract import QUALITY_EVENTS


def sample_bucket(event_id: Column) -> Column:
    """A number in 0..9999 fixed by the id: the first 28 bits of its SHA-256."""
    head = F.conv(F.substring(F.sha2(event_id, 256), 1, 7), 16, 10).cast("long")
    return F.pmod(head, F.lit(10_000))


def sampled(event_id: Column, pct: float | Column) -> Column:
    return sample_bucket(event_id) < F.lit(pct) * 100 if not isinstance(pct, Column) else sample_bucket(event_id) < pct * 100


def quality_sample(event_type: Column, status: Column, event_id: Column, pct: float = 5.0) -> Column:
    """Successful completions picked for evaluation."""
    return event_type.isin(QUALITY_EVENTS) & (status == "success") & sampled(event_id, pct)


def stratified_sample(event_type: Column, event_id: Column, rag_pct: float = 100.0, llm_pct: float = 10.0) -> Column:
    """Per-stratum evaluation sampling: all retrievals, a share of plain model calls."""
    return F.when(event_type == "RAG_RETRIEVAL_COMPLETED", sampled(event_id, rag_pct)).when(
        event_type == "LLM_CALL_COMPLETED", sampled(event_id, llm_pct)
    ).otherwise(False)
