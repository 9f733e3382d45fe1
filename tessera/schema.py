"""Schemas and thresholds of the manifest stages."""

from __future__ import annotations

from dataclasses import dataclass

MANIFEST = (
    "audio_path string, text string, speaker_id string, duration double, source string, sample_rate int, channels int, peak_db double, rms_db double, "
    "clipping_ratio double, silence_ratio double, quality_grade string, speech_ratio double, text_raw string"
)
REGISTRY = "step bigint, val_loss double, trainer_id string, shard_index int, path string, created double"
REQUIRED = ("audio_path", "text", "speaker_id", "duration")


@dataclass(frozen=True)
class Limits:
    """Grade limits. A clip outside the first group is D."""

    shortest: float = 0.5
    longest: float = 20.0
    clipping: float = 0.01
    rate: int = 16000
    silence: float = 0.6
    a_rate: int = 16000
    a_silence: float = 0.2
    a_rms: tuple[float, float] = (-30.0, -12.0)
    b_silence: float = 0.4
    b_rms: float = -35.0
