"""Header maps (name -> values) and subjects of messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ANNOUNCEMENT, MESSAGE_ID, SERVICE_HEADERS, SHARD


def first_value(headers: Column, name: str) -> Column:
    return F.get(F.try_element_at(headers, F.lit(name)), F.lit(0))


def preserve(headers: Column, msg_id: Column) -> Column:
    """Custom headers without those of the log's own service, and the new message id."""
    kept = F.map_filter(headers, lambda k, _: ~k.isin(*SERVICE_HEADERS))
    return F.map_concat(kept, F.create_map(F.lit(MESSAGE_ID), F.array(msg_id)))


def copied(headers: Column, seq: Column, state_header: str, drop_msg_id: bool = False) -> Column:
    """Headers of a verbatim copy: none that begin with "nats-" but the message id (unless dropped), and the original's seq, which replaces an older one."""

    def keep(k: Column, _: Column) -> Column:
        own = F.lower(k) == MESSAGE_ID.lower()
        service = F.startswith(F.lower(k), F.lit("nats-"))
        return (~service | (own & F.lit(not drop_msg_id))) & (k != state_header)

    return F.map_concat(F.map_filter(headers, keep), F.create_map(F.lit(state_header), F.array(seq.cast("string"))))


def subject_pattern(tokens: str) -> str:
    """Regular expression of a subject with wildcards: * is one token, > one or more at the end."""
    parts = []
    for t in tokens.split("."):
        parts.append(r"[^.]+" if t == "*" else r".+" if t == ">" else "".join("\\" + c if not c.isalnum() and c != "_" else c for c in t))
    return "^" + r"\.".join(parts) + "$"


def matches_subject(subject: Column, filters: list[str]) -> Column:
    """Whether any filter matches; [">"] and [] let all pass."""
    if not filters or ">" in filters:
        return F.lit(True)
    out = F.lit(False)
    exact = [f for f in filters if "*" not in f.split(".") and not f.endswith(">")]
    if exact:
        out = subject.isin(exact)
    for f in filters:
        if f not in exact:
            out = out | subject.rlike(subject_pattern(f))
    return out


def routed(pattern: str, block_type: Column, shard_id: Column) -> Column:
    """The subject of a written block: * becomes "header", the shard id or "unknown"."""
    part = F.when(block_type == ANNOUNCEMENT, "header").when(block_type == SHARD, shard_id.cast("string")).otherwise("unknown")
    return F.replace(F.lit(pattern), F.lit("*"), part)
