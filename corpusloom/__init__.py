"""Web pages to cleaned text, chunks, prompts and dialogue records, as Spark DataFrames."""

from corpusloom.options import (
    ChunkOptions,
    QualityOptions,
    RecordOptions,
    StructureOptions,
)

__all__ = ["ChunkOptions", "QualityOptions", "RecordOptions", "StructureOptions"]
