"""Thresholds and switches of the quality gate, captured as literals in the plan."""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace


#: Tables that every run writes under these names.
RESERVED_SINKS = ("verdict", "reason_counts", "rejection_reasons", "rejection_reason_analysis", "processing_stats")

_TINY, _MANY = 5e-324, float("inf")
#: Field, least and largest value.
_RANGES = [
    ("min_duration", _TINY, _MANY),
    ("max_duration", _TINY, _MANY),
    ("audio_min_duration", 0, _MANY),
    ("audio_max_duration", _TINY, _MANY),
    ("min_sample_rate", 0, _MANY),
    ("max_sample_rate", 1, _MANY),
    ("min_amplitude", 0, _MANY),
    ("max_silence_ratio", 0, 1),
    ("min_text_quality_score", 0, 1),
    ("max_repeated_word_ratio", 0, 1),
    ("min_word_count", 0, _MANY),
]
_ORDERED = [
    ("min_duration", "max_duration"),
    ("audio_min_duration", "audio_max_duration"),
    ("min_sample_rate", "max_sample_rate"),
]


@dataclass(frozen=True)
class GateConfig:
    # duration of the utterance table, seconds
    min_duration: float = 0.5
    max_duration: float = 15.0

    # audio property rules; independent of the two values above
    audio_min_duration: float = 0.5
    audio_max_duration: float = 15.0
    min_sample_rate: int = 8000
    max_sample_rate: int = 48000
    min_amplitude: float = 1e-6
    max_silence_ratio: float = 0.8

    # text quality
    min_text_quality_score: float = 0.3
    max_repeated_word_ratio: float = 0.8
    min_word_count: int = 2

    # optional checks
    check_language_mismatch: bool = True
    check_audio: bool = True
    # a path with this prefix and no property row counts as existing and sound;
    # None makes every path without a property row `file_not_found`
    assume_exists_prefix: str | None = "s3://"

    # normaliser steps
    apply_unicode_nfc: bool = True
    remove_diacritics: bool = True
    expand_numbers: bool = True
    normalize_punctuation: bool = True
    # keep combining marks that belong to words, such as vowel signs, in the normalised text
    keep_marks: bool = False

    # sinks
    train_ready_name: str = "train_ready"
    rejected_name: str = "rejected"
    include_stats: bool = True

    def __post_init__(self) -> None:
        for name, low, high in _RANGES:
            value = getattr(self, name)
            if not low <= value <= high:
                raise ValueError(f"{name} is {value}; it must lie in {low} to {high}")
        for low, high in _ORDERED:
            if getattr(self, low) >= getattr(self, high):
                raise ValueError(f"{low} ({getattr(self, low)}) must be below {high} ({getattr(self, high)})")
        names = {self.train_ready_name.lower(), self.rejected_name.lower()}
        if len(names) < 2 or names & set(RESERVED_SINKS):
            raise ValueError(f"sinks need two names of their own, other than {', '.join(RESERVED_SINKS)}")

    def normalize_only(self) -> GateConfig:
        """Text gates wide open; presence, duration, path, script, audio and flag gates still run."""
        return replace(
            self, min_text_quality_score=0.0, min_word_count=0, max_repeated_word_ratio=1.0
        )

    def skip_language_mismatch(self) -> GateConfig:
        return replace(self, check_language_mismatch=False)

    def skip_audio(self) -> GateConfig:
        return replace(self, check_audio=False)

    def sections(self) -> dict[str, dict]:
        """The settings by section, as the statistics document lists them."""
        every = asdict(self)
        return {
            "audio_validation": {
                "min_duration": self.min_duration,
                "max_duration": self.max_duration,
                **{
                    k: every[k]
                    for k in (
                        "audio_min_duration",
                        "audio_max_duration",
                        "min_sample_rate",
                        "max_sample_rate",
                        "min_amplitude",
                        "max_silence_ratio",
                        "check_audio",
                        "assume_exists_prefix",
                    )
                },
            },
            "text_normalization": {
                k: every[k]
                for k in (
                    "apply_unicode_nfc",
                    "remove_diacritics",
                    "expand_numbers",
                    "normalize_punctuation",
                    "keep_marks",
                )
            },
            "quality_thresholds": {
                k: every[k]
                for k in (
                    "min_text_quality_score",
                    "max_repeated_word_ratio",
                    "min_word_count",
                    "check_language_mismatch",
                )
            },
            "output": {k: every[k] for k in ("train_ready_name", "rejected_name", "include_stats")},
        }
