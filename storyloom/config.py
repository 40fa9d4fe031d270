"""Thresholds of captions, entities and validation. Fixed values, in the units that their names say."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CaptionLimits:
    trailing_unaligned_words: int = 3
    speaker_ratio: float = 3.639593909
    max_cue_chars: int = 74
    target_chars: int = 42
    min_cue_ms: int = 1000
    max_cue_ms: int = 6000
    target_ms: int = 3500
    max_lines: int = 3


@dataclass(frozen=True)
class EntityLimits:
    first_year: int = 1500
    last_year: int = 2199
    first_strong_year: int = 1900
    adjacency_chars: int = 4
    date_confidence_max: int = 6
    value_chars: int = 32


DURATION_TOLERANCE_MS = 150
SEGMENT_SECONDS = (5, 900)
