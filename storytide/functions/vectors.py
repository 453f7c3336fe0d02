"""Vector arithmetic on ``array<double>`` columns, as SQL expressions.

The functions take and return SQL text, so that a long formula is handed to Spark in
one piece and evaluated inside the JVM.
"""

from __future__ import annotations


def dot(left: str, right: str) -> str:
    """Inner product; positions missing on either side count as zero."""
    products = f"zip_with({left}, {right}, (x, y) -> x * y)"
    return f"aggregate({products}, 0D, (total, p) -> total + coalesce(p, 0D))"


def norm(vector: str) -> str:
    return f"sqrt(aggregate({vector}, 0D, (total, x) -> total + x * x))"


def cosine(left: str, right: str, left_norm: str, right_norm: str) -> str:
    """Cosine with the norms given; 0 for null or zero vectors."""
    norms = f"({left_norm} * {right_norm})"
    return f"CASE WHEN {norms} > 0 THEN {dot(left, right)} / {norms} ELSE 0D END"


def flat_arc(arc: str, with_position: bool = True) -> str:
    """An arc as one vector; the leading chunk position of each point is optional."""
    return f"flatten({arc})" if with_position else f"flatten(transform({arc}, p -> slice(p, 2, 8)))"
