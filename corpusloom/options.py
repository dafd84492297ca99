"""Operator parameters. Plain values, passed to operators by the caller."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ChunkOptions:
    """Section and chunk sizes, in tokens unless the name says otherwise."""

    max_tokens: int = 3500
    heading_reserve: int = 100
    orphan_words: int = 15

    def __post_init__(self):
        if self.max_tokens <= self.heading_reserve:
            raise ValueError("max_tokens must be larger than heading_reserve")


@dataclass(frozen=True)
class StructureOptions:
    """When a table, list or nested list is long, and how much of it one part holds."""

    list_items_per_part: int = 12
    table_rows_per_part: int = 8
    nested_groups_per_part: int = 8
    min_list_items: int = 25
    min_table_rows: int = 15
    min_nested_groups: int = 5
    min_nested_items: int = 12

    def __post_init__(self):
        for name in ("list_items_per_part", "table_rows_per_part", "nested_groups_per_part"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")


@dataclass(frozen=True)
class QualityOptions:
    """Inclusive bounds for question/answer pairs."""

    min_pairs: int = 10
    max_pairs: int = 30
    min_instruction_words: int = 6
    max_instruction_words: int = 48
    min_output_words: int = 14
    max_output_words: int = 200


@dataclass(frozen=True)
class RecordOptions:
    """Metadata and logging of generated records."""

    lang: str = "en"
    retry_limit: int = 1
    logged_chars: int = 2000
