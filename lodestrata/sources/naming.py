"""Names of streams, checkpoints and dead letters, one set for each entity."""

from __future__ import annotations

from ..operators.derive import ENTITIES


def stream(prefix: str, consumer: str, entity: str) -> str:
    """``prefix-consumer-entity``; an unknown entity is an error."""
    if entity not in ENTITIES:
        raise ValueError(f"unknown entity {entity!r}")
    return f"{prefix}-{consumer}-{entity}"


def dead_letter_exchange(prefix: str, consumer: str, entity: str) -> str:
    return stream(prefix, consumer, entity) + ".dlx"


def dead_letters(prefix: str, consumer: str, entity: str) -> str:
    return stream(prefix, consumer, entity) + ".dlq"
