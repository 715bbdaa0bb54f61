"""Parameter files and sky-model file choice (small, on the driver)."""

from __future__ import annotations

from collections.abc import Iterable


def read_parameters(lines: Iterable[str], kinds: dict[str, type]) -> dict:
    """``key : value`` lines with ``#`` comments; unknown keys raise."""
    found = {}
    for line in lines:
        line = line.split("#", 1)[0].strip()
        if not line:
            continue
        key, _, value = (x.strip() for x in line.partition(":"))
        if key not in kinds:
            raise ValueError(f"unknown parameter {key!r}")
        kind = kinds[key]
        found[key] = [x.strip() for x in value.split(",")] if kind is list else kind(value)
    return found


def override(base: dict, given: dict) -> dict:
    """Explicitly given values over the file's."""
    return base | {k: v for k, v in given.items() if v is not None}


def parameter_set(band: str, bandwidth_hz: float) -> str:
    """Name of the parameter set for a band and bandwidth."""
    width = "narrow_54" if bandwidth_hz <= 54e6 else "narrow_107" if bandwidth_hz <= 107e6 else "wide"
    return f"{band.upper()}_{width}"


def choose_model(names: Iterable[str], files_by_dir: list[list[str]], band: str) -> str | None:
    """Model file of a target: the earliest directory wins; of several files there, the band's own, else the first."""
    wanted = [n.replace(" ", "") for n in names]
    for files in files_by_dir:
        hits = sorted(f for f in files if f.endswith(".txt") and any(n in f for n in wanted))
        if len(hits) == 1:
            return hits[0]
        if hits:
            return next((f for f in hits if f.endswith(f"_{band.upper()}.txt")), hits[0])
    return None
