"""Settings of the speech-corpus plans; their values enter expressions as literals.

Fixed values: sections, names and defaults are those of the configuration files that the plans read.
Model names, devices and the like are for plugins, which get them from here; no plan reads them.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields, is_dataclass, replace


@dataclass(frozen=True)
class Audio:
    target_sr: int = 16_000
    edge_pad_s: float = 0.15
    mono_per_channel: bool = True
    n_mels: int = 128
    #: "sinc": band-limited; "linear": interpolation.
    resampler: str = "sinc"


@dataclass(frozen=True)
class Chunking:
    min_s: float = 1.0
    max_s: float = 28.0
    target_mean_s: float = 12.0
    merge_gap_max_s: float = 1.5
    silence_cut_min_s: float = 0.3
    pause_cut_s: float = 0.4
    trim_silence_edges: bool = True
    trim_margin_s: float = 0.2
    split_long_silence: bool = True
    split_silence_s: float = 1.2
    short_band: tuple[float, float] = (3.0, 8.0)
    mid_band: tuple[float, float] = (8.0, 18.0)
    long_band: tuple[float, float] = (18.0, 28.0)


@dataclass(frozen=True)
class Overlap:
    keep: bool = True
    max_fraction_of_dataset: float = 0.12
    drop_if_overlap_fraction_above: float = 0.6


@dataclass(frozen=True)
class Confidence:
    w_align: float = 0.5
    w_agree: float = 0.5
    accept_at: float = 0.85
    review_below: float = 0.6
    downweight_loss: float = 0.5
    use_forced_alignment: bool = True
    use_second_asr: bool = True


@dataclass(frozen=True)
class Gates:
    require_audio_quality_good: bool = False
    max_silence_ratio: float = 0.6
    cps_min: float = 3.0
    cps_max: float = 28.0
    min_persian_char_ratio: float = 0.55
    min_chars: int = 2


@dataclass(frozen=True)
class Split:
    test_fraction: float = 0.05
    gold_oversample: int = 3
    seed: int = 1337
    #: "shuffle": a seeded shuffle of all ids, on the driver, for bounded corpora; "digest": a seeded digest, for any.
    method: str = "shuffle"


@dataclass(frozen=True)
class SecondTranscript:
    enabled: bool = True
    model_id: str = "openai/whisper-large-v3"
    device: str = "cuda"
    language: str = "fa"
    batch_size: int = 8


@dataclass(frozen=True)
class Alignment:
    enabled: bool = True
    backend: str = "whisperx"
    device: str = "cuda"
    language: str = "fa"


@dataclass(frozen=True)
class WordAlignment:
    enabled: bool = True
    model_id: str = "MahmoudAshraf/mms-300m-1130-forced-aligner"
    device: str = "cuda"
    dtype: str = "float16"
    language: str = "fas"
    romanize: bool = True
    batch_size: int = 8
    min_word_score: float = 0.0


@dataclass(frozen=True)
class Settings:
    audio: Audio = field(default_factory=Audio)
    chunk: Chunking = field(default_factory=Chunking)
    overlap: Overlap = field(default_factory=Overlap)
    confidence: Confidence = field(default_factory=Confidence)
    filt: Gates = field(default_factory=Gates)
    split: Split = field(default_factory=Split)
    second_asr: SecondTranscript = field(default_factory=SecondTranscript)
    align: Alignment = field(default_factory=Alignment)
    forced_align: WordAlignment = field(default_factory=WordAlignment)

    def to_dict(self) -> dict:
        return asdict(self)


def overlay(base, changes: dict | None):
    """``base`` with the known keys of ``changes``; unknown keys and empty sections change nothing."""
    known = {f.name for f in fields(base)}
    new = {}
    for key, value in (changes or {}).items():
        if key not in known:
            continue
        have = getattr(base, key)
        if is_dataclass(have):
            new[key] = overlay(have, value)
        elif isinstance(have, tuple) and isinstance(value, list):
            new[key] = tuple(value)
        else:
            new[key] = value
    return replace(base, **new)


def load_settings(path: str | None = None) -> Settings:
    """Defaults, overlaid by a YAML file."""
    if not path:
        return Settings()
    import yaml

    with open(path, encoding="utf-8") as f:
        return overlay(Settings(), yaml.safe_load(f))
