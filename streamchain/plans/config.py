"""Options of programs, with their defaults. Fixed values."""

from __future__ import annotations

from ..operators.chain import Anchor, Bridge
from ..operators.tolerance import Tolerances
from ..operators.verify import VERIFIERS

#: What a bridge tolerates unless told otherwise.
TOLERANCES = Tolerances(corrupted=-1, low=100_000, high=-1, wrong=1000, no_write=-1)


def bridge(kind: str = "headers_only", headers_only: bool = False, shard_filter: list[bool] | None = None, **options) -> Bridge:
    """A bridge for a payload format; ``headers_only`` keeps the format's gap rule and drops its other checks. Anchors at input seq 1."""
    verifier = VERIFIERS[kind]
    verifier = verifier.headers_only() if headers_only else verifier
    if shard_filter is not None:
        verifier = type(verifier)(verifier.allow_gaps, verifier.check_completion, verifier.check_hashes, tuple(shard_filter), verifier.hash_ci)
    return Bridge(verifier=verifier, **({"tolerances": TOLERANCES, "anchor": Anchor(seq=1)} | options))
