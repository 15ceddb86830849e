"""Verification of a row against the one accepted before it: as a column over pairs, and as a function for folds."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.msgid import parse
from ..functions.shardmask import next_needed, passes
from ..schema import ANNOUNCEMENT, REASON_CLASS, SHARD
from . import prefix

FIELDS = ("height", "block_type", "shard_id", "hash", "prev_hash", "shard_mask")


@dataclass(frozen=True)
class Verifier:
    """Which rules hold. ``shard_filter``: None lets all shards pass, an empty list none."""

    allow_gaps: bool = True
    check_completion: bool = False
    check_hashes: bool = False
    shard_filter: tuple[bool, ...] | None = None
    hash_ci: bool = False

    def headers_only(self) -> Verifier:
        return replace(self, check_completion=False, check_hashes=False)

    def without_filter(self) -> Verifier:
        return replace(self, shard_filter=None)

    def column(self, last: str = "last_", next_: str = "") -> Column:
        """The reason, from columns with these prefixes; a null last height is no predecessor. First rule that applies wins.

        A predecessor whose hash is unknown (null) fails no hash rule.
        """
        a, b = ({f: F.col(f"{p}{f}") for f in FIELDS if f not in self._unused()} for p in (last, next_))
        folded = (lambda c: F.lower(c)) if self.hash_ci else (lambda c: c)
        shard = b["block_type"] == SHARD
        flt = F.lit(None).cast("array<boolean>") if self.shard_filter is None else F.array(*map(F.lit, self.shard_filter)).cast("array<boolean>")
        up, same = b["height"] > a["height"], b["height"] == a["height"]
        rules: list[tuple[Column, str]] = []
        if self.shard_filter is not None:
            rules.append((shard & ~passes(flt, b["shard_id"]), "FilteredShard"))
        rules += [(a["height"].isNull(), "OK"), (b["height"] < a["height"], "LowHeight")]
        if self.check_completion:
            needed = next_needed(a["shard_mask"], a["block_type"], a["shard_id"], flt)
            rules.append((up & needed.isNotNull(), "IncompletePreviousBlock"))
        rules.append((up & (b["block_type"] != ANNOUNCEMENT), "UnannouncedBlock"))
        if not self.allow_gaps:
            rules.append((up & (b["height"] - a["height"] > 1), "HeightGap"))
        if self.check_hashes:
            rules.append((up & (folded(b["prev_hash"]) != folded(a["hash"])), "HashMismatch"))
        rules += [
            (up, "OK"),
            (same & (b["block_type"] == ANNOUNCEMENT), "Reannouncement"),
            (~shard, "UnknownBlockType"),
            ((a["block_type"] == SHARD) & (b["shard_id"] <= a["shard_id"]), "LowShard"),
        ]
        if self.check_completion:
            rules += [(needed.isNull(), "UnwantedShard"), (b["shard_id"] < needed, "LowShard"), (b["shard_id"] > needed, "ShardGap")]
        if self.check_hashes:
            rules.append((folded(b["hash"]) != folded(a["hash"]), "ShardHashConflict"))
        out = F.when(*_rule(rules[0]))
        for rule in rules[1:]:
            out = out.when(*_rule(rule))
        return out.otherwise("OK")

    def _unused(self) -> set[str]:
        return (set() if self.check_completion else {"shard_mask"}) | (set() if self.check_hashes else {"hash", "prev_hash"})

    def reason(self, last: dict | None, row: dict) -> str:
        """The same for two rows as dicts, in folds."""
        shard = row["block_type"] == SHARD
        if shard and not self._passes(row["shard_id"]):
            return "FilteredShard"
        if last is None:
            return "OK"
        step = row["height"] - last["height"]
        if step < 0:
            return "LowHeight"
        needed = self._needed(last) if self.check_completion else None
        if step > 0:
            if needed is not None:
                return "IncompletePreviousBlock"
            if row["block_type"] != ANNOUNCEMENT:
                return "UnannouncedBlock"
            if step > 1 and not self.allow_gaps:
                return "HeightGap"
            return "HashMismatch" if self.check_hashes and self._differ(row["prev_hash"], last["hash"]) else "OK"
        if row["block_type"] == ANNOUNCEMENT:
            return "Reannouncement"
        if not shard:
            return "UnknownBlockType"
        if last["block_type"] == SHARD and row["shard_id"] <= last["shard_id"]:
            return "LowShard"
        if self.check_completion:
            if needed is None:
                return "UnwantedShard"
            if row["shard_id"] != needed:
                return "LowShard" if row["shard_id"] < needed else "ShardGap"
        return "ShardHashConflict" if self.check_hashes and self._differ(row["hash"], last["hash"]) else "OK"

    def beyond(self, last: dict, row: dict) -> bool:
        """Whether a row that the filter lets pass is too high by its height alone, as all higher ones are then."""
        return not self.allow_gaps and row["height"] - last["height"] > 1

    def _passes(self, shard: int) -> bool:
        f = self.shard_filter
        return f is None or (shard < len(f) and f[shard])

    def _needed(self, last: dict) -> int | None:
        mask = last["shard_mask"]
        mask = () if mask is None else mask
        start = last["shard_id"] + 1 if last["block_type"] == SHARD else 0
        return next((i for i in range(start, len(mask)) if mask[i] and self._passes(i)), None)

    def _differ(self, a: str | None, b: str | None) -> bool:
        if a is None or b is None:
            return False
        return a.lower() != b.lower() if self.hash_ci else a != b


def _rule(rule: tuple[Column, str]) -> tuple[Column, str]:
    return F.coalesce(rule[0], F.lit(False)), rule[1]


class Transparent(Verifier):
    """Accepts everything, for copies that aren't checked."""

    def column(self, last: str = "last_", next_: str = "") -> Column:
        return F.lit("OK")

    def reason(self, last: dict | None, row: dict) -> str:
        return "OK"

    def beyond(self, last: dict, row: dict) -> bool:
        return False


#: By payload format (see sources.decode).
VERIFIERS = {
    "headers_only": Verifier(),
    "json_lz4": Verifier(check_hashes=True),
    "cbor_map": Verifier(allow_gaps=False, check_hashes=True),
    "proto_zstd": Verifier(check_completion=True, check_hashes=True),
}


def reason_class(reason: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in REASON_CLASS.items() for x in pair)), reason)


def pairwise(log: DataFrame, verifier: Verifier, segment: int = prefix.SEGMENT) -> DataFrame:
    """The rows with the reason against the row just before in their stream, and its class: an audit of the log as it is."""
    fields = [f for f in FIELDS if f in log.columns]
    rows = prefix.previous(log, {f"last_{f}": f for f in fields}, segment=segment)
    rows = rows.withColumn("reason", verifier.column())
    return rows.withColumn("class", reason_class(F.col("reason"))).drop(*[f"last_{f}" for f in fields])


def violations(log: DataFrame, contiguous: bool = False, hash_ci: bool = False, segment: int = prefix.SEGMENT) -> DataFrame:
    """Rows that break the validator's pair rules: the height rises (by one, if ``contiguous``), and prev_hash is the hash before."""
    rows = prefix.previous(log, {"last_height": "height", "last_hash": "hash"}, segment=segment)
    folded = (lambda c: F.lower(F.col(c))) if hash_ci else F.col
    broken = F.when(F.col("height") <= F.col("last_height"), "height")
    if contiguous:
        broken = broken.when(F.col("height") != F.col("last_height") + 1, "gap")
    broken = broken.when(folded("prev_hash") != folded("last_hash"), "hash")
    return rows.withColumn("violation", broken).filter("violation is not null").drop("last_height", "last_hash")


def id_mismatches(log: DataFrame, msg_id: Column) -> DataFrame:
    """Rows whose message id is missing, malformed, or tells another height than the block; shards are not compared."""
    told = parse(msg_id)
    wrong = F.when(F.coalesce(msg_id, F.lit("")) == "", "missing").when(told["error"].isNotNull(), "malformed").when(told["height"] != F.col("height"), "height")
    return log.withColumn("mismatch", wrong).filter("mismatch is not null")


def first_violation(log: DataFrame, **rules) -> DataFrame:
    """The first row of each stream that breaks a rule; all rows before it are valid."""
    found = violations(log, **rules)
    return found.groupBy("stream_id").agg(F.min("seq").alias("seq"), F.min_by("violation", "seq").alias("violation"))
