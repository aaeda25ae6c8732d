"""Options of a run, as frozen values with checks."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

from ..operators.identity import Limits


@dataclass(frozen=True)
class CropOptions:
    most_per_track: int = 16
    least_height: int = 150
    padding: float = 0.08
    least_blur: float = 110.0
    mask_mode: str = "bbox"
    least_mask: float = 0.02
    least_shape: float = 0.35
    most_edge: float = 0.75


@dataclass(frozen=True)
class TrackOptions:
    active_filter: bool = True
    least_frames: int = 25
    least_movement: float = 0.04
    least_seconds: float = 0.8


@dataclass(frozen=True)
class ClusterOptions:
    method: str = "agglomerative"
    distance: float = 0.18
    identity_split: bool = True
    limits: Limits = field(default_factory=Limits)


@dataclass(frozen=True)
class ExportOptions:
    filtered: bool = True
    accept: float = 0.78
    review: float = 0.55
    include_all: bool = False
    gallery: bool = True


@dataclass(frozen=True)
class Options:
    extensions: tuple[str, ...] = (".mp4", ".mov", ".avi", ".mkv")
    most_videos: int | None = None
    crops: CropOptions = field(default_factory=CropOptions)
    tracks: TrackOptions = field(default_factory=TrackOptions)
    clusters: ClusterOptions = field(default_factory=ClusterOptions)
    export: ExportOptions = field(default_factory=ExportOptions)


def extension_list(text: str) -> tuple[str, ...]:
    """Comma-separated extensions: lower case, one leading dot, no repeats, in order."""
    names = [("." + x.strip().lower().lstrip(".")) for x in text.split(",") if x.strip(" .")]
    if not names:
        raise ValueError("no extension")
    return tuple(dict.fromkeys(names))


def parse_truth(value) -> bool:
    if isinstance(value, bool):
        return value
    word = str(value).strip().lower()
    if word in ("1", "true", "yes", "y", "on"):
        return True
    if word in ("0", "false", "no", "n", "off"):
        return False
    raise ValueError(f"not a boolean: {value}")


def check(options: Options) -> Options:
    """The options, if every value lies in its range."""
    limits = options.clusters.limits
    share = lambda x: 0.0 <= x <= 1.0
    rules = {
        "most_per_track must be positive": options.crops.most_per_track > 0,
        "least_frames must not be negative": options.tracks.least_frames >= 0,
        "method must be agglomerative": options.clusters.method == "agglomerative",
        "mask_mode must be bbox, masked or both": options.crops.mask_mode in ("bbox", "masked", "both"),
        "distance must lie in [0, 2]": 0.0 <= options.clusters.distance <= 2.0 and 0.0 <= limits.split_distance <= 2.0,
        "split_size must be at least 2": limits.split_size >= 2,
        "limits must lie in [0, 1]": all(share(getattr(limits, f.name)) for f in fields(limits) if f.name not in ("split_size", "split_distance")),
        "crop shares must lie in [0, 1]": share(options.crops.least_shape) and share(options.crops.most_edge),
        "review must not exceed accept": share(options.export.review) and share(options.export.accept) and options.export.review <= options.export.accept,
        "most_videos must be positive": options.most_videos is None or options.most_videos > 0,
    }
    for message, fine in rules.items():
        if not fine:
            raise ValueError(message)
    return options


def restored(saved: dict, base: Options = Options()) -> Options:
    """Options from a saved document; what a section lacks keeps its default, unknown names are ignored."""
    out = base
    for section in ("crops", "tracks", "clusters", "export"):
        own = getattr(base, section)
        known = {f.name for f in fields(own)} - {"limits"}
        out = replace(out, **{section: replace(own, **{k: v for k, v in saved.get(section, {}).items() if k in known})})
    if "limits" in saved:
        out = replace(out, clusters=replace(out.clusters, limits=replace(out.clusters.limits, **{k: v for k, v in saved["limits"].items() if k in {f.name for f in fields(Limits)}})))
    return check(out)
