"""Parameters in frequency units, resolved to channels for a server's slice."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Axis:
    """The channel axis and the server's slice of it."""

    n_chans: int
    bandwidth: float
    centre: float
    servers: int = 1
    server_id: int = 0

    def __post_init__(self):
        if self.n_chans % self.servers:
            raise ValueError("the servers must divide the channels")
        if not 0 <= self.server_id < self.servers:
            raise ValueError("no such server")

    @property
    def width(self) -> float:
        return self.bandwidth / self.n_chans

    @property
    def per_server(self) -> int:
        return self.n_chans // self.servers

    def frequency(self, chan: int) -> float:
        return self.centre + self.width * (chan - self.n_chans // 2)

    def below(self, hz: float) -> int:
        """Channels below a frequency (a left search)."""
        return min(self.n_chans, max(0, math.ceil((hz - self.frequency(0)) / self.width - 1e-9)))


def channel_window(axis: Axis, begin_mhz: Sequence[float], end_mhz: Sequence[float]) -> list[tuple[int, int]]:
    """[begin, end) channels of frequency windows; the end is one less than its left search."""
    if len(begin_mhz) != len(end_mhz):
        raise ValueError("begin and end differ in number")
    return [(axis.below(b * 1e6), axis.below(e * 1e6) - 1) for b, e in zip(begin_mhz, end_mhz, strict=True)]


def resolve_window(axis: Axis, params: dict, prefix: str) -> tuple[int, int]:
    """Window of a prefix: the channel form wins over the frequency form; neither is an error."""
    b, e = f"{prefix}_bchan", f"{prefix}_echan"
    if b in params and e in params:
        window = (params[b], params[e])
    elif f"{prefix}_bfreq" in params and f"{prefix}_efreq" in params:
        window = channel_window(axis, params[f"{prefix}_bfreq"][:1], params[f"{prefix}_efreq"][:1])[0]
    else:
        raise ValueError(f"no window for {prefix!r}")
    if not 0 <= window[0] < window[1] <= axis.n_chans:
        raise ValueError(f"bad window for {prefix!r}: {window}")
    if window[0] // axis.per_server != (window[1] - 1) // axis.per_server:
        raise ValueError(f"the window for {prefix!r} spans servers")
    return window


def to_local(axis: Axis, chan: int) -> int:
    return chan - axis.server_id * axis.per_server


def to_global(axis: Axis, chan: int) -> int:
    return chan + axis.server_id * axis.per_server


def server_share(total: int, servers: int) -> int:
    return -(-total // servers)


def flagger_widths(axis: Axis, average_hz: float, spike_hz: float, extend_hz: float, windows: Sequence[int]) -> dict:
    """Averaging factor, spike width, extension (odd), and windows before averaging (first is 1)."""
    average = max(1, math.ceil(average_hz / axis.width))
    extend = max(3, int(math.ceil(extend_hz / axis.width)) // 2 * 2 + 1)
    scaled = [w * average for w in windows]
    return {"average": average, "spike": spike_hz / axis.width, "extend": extend, "windows": [1, *scaled[1:]] if scaled else []}


def unmasked_runs(masked: Sequence[bool]) -> list[tuple[int, int]]:
    """[first, last] of the runs of unmasked channels."""
    runs, start = [], None
    for i, m in enumerate([*masked, True]):
        if not m and start is None:
            start = i
        elif m and start is not None:
            runs.append((start, i - 1))
            start = None
    return runs


def blank_window(axis: Axis, masked: Sequence[bool], most: int = 6400) -> tuple[int, int]:
    """[first, last] of the longest unmasked run inside one server.

    A run of ``most`` channels or more is cut to half of ``most`` on each side of its middle
    channel (the last is where the window ends); a shorter one is kept whole.
    Ties: the lowest server, and in a server its last run.
    """
    most = min(most, axis.per_server)
    best = None
    for s in range(axis.servers):
        lo = s * axis.per_server
        for first, last in unmasked_runs(masked[lo : lo + axis.per_server]):
            length = last - first + 1
            if best is None or length > best[0] or (length == best[0] and s == best[1]):
                best = (length, s, lo + first, lo + last)
    if best is None:
        raise ValueError("every channel is masked")
    length, _, first, last = best
    if length >= most:
        middle = first + length // 2
        return middle - most // 2, middle + most // 2
    return first, last


#: Parameters that are taken as they are, with their types; the last two are shared out among the servers.
PLAIN = {
    "k_solint": float, "k_chan_sample": int, "kcross_chanave": int, "bp_solint": float, "g_solint": float, "rfi_calib_nsigma": float, "rfi_targ_nsigma": float, "rfi_spike_width_time": float,
    "bcross_sky_knots": list, "bcross_sky_coefs": list, "bcross_sky_k": int, "rfi_freq_chunks": int, "epoint_freq_chunks": int,
}
SHARED = ("rfi_freq_chunks", "epoint_freq_chunks")
#: Channel form of a width and its form in Hz.
WIDTHS = {"rfi_average_freq": "rfi_average_hz", "rfi_targ_spike_width_freq": "rfi_targ_spike_width_hz", "rfi_calib_spike_width_freq": "rfi_calib_spike_width_hz", "rfi_extend_freq": "rfi_extend_hz", "rfi_windows_freq": "rfi_windows_post_average"}
WINDOWS = ("k", "g")
#: Parameters that may be left out.
OPTIONAL = ("subband_bfreq", "array_position")


def known_names() -> set[str]:
    ends = {f"{p}_{e}{f}" for p in WINDOWS for e in "be" for f in ("chan", "freq")}
    return {*PLAIN, *WIDTHS, *WIDTHS.values(), *OPTIONAL, *ends}


def blank_prefixes(given: dict) -> list[str]:
    """Prefixes whose frequency window is given and empty at both ends."""
    return [p for p in WINDOWS if given.get(f"{p}_bfreq", 0) == given.get(f"{p}_efreq", 0) == []]


def for_subband(axis: Axis, values: Sequence[float], starts: Sequence[float] | None) -> list[float]:
    """The one value of the last sub-band that starts at or below the axis."""
    if len(values) < 2:
        return list(values)
    below = [k for k, s in enumerate(starts or ()) if axis.frequency(0) >= s * 1e6]
    if not below:
        raise ValueError("values for several sub-bands need subband_bfreq")
    return [values[below[-1]]]


def width_in_channels(axis: Axis, name: str, value, average: int):
    """A width in Hz (or windows on averaged data) as channels."""
    if name == "rfi_windows_freq":
        return [1, *(int(w * average) for w in value[1:])] if value else []
    chans = math.ceil(value / axis.width)
    return max(3, chans // 2 * 2 + 1) if name == "rfi_extend_freq" else chans


def resolve(axis: Axis, given: dict, masked: Sequence[bool] | None = None) -> dict:
    """All parameters of a server, in its local channels; ``masked`` (per channel) is needed for blank windows.

    The channel form of a parameter wins over its frequency form.  Unknown names, missing parameters,
    bad ranges and windows over several servers are errors.
    """
    unknown = set(given) - known_names()
    if unknown:
        raise ValueError(f"unknown parameters: {', '.join(sorted(unknown))}")
    p, out = dict(given), {}
    for prefix in blank_prefixes(p):
        if masked is None:
            raise ValueError(f"a blank window for {prefix!r} needs the mask")
        first, last = blank_window(axis, masked)
        p[f"{prefix}_bfreq"], p[f"{prefix}_efreq"] = [axis.frequency(first) / 1e6], [axis.frequency(last) / 1e6]
    for prefix in WINDOWS:
        for key in (f"{prefix}_bfreq", f"{prefix}_efreq"):
            if key in p:
                p[key] = for_subband(axis, p[key], p.get("subband_bfreq"))
        window = resolve_window(axis, p, prefix)
        out[f"{prefix}_bchan"], out[f"{prefix}_echan"] = (to_local(axis, c) for c in window)
        if not 0 <= out[f"{prefix}_bchan"] < axis.per_server:
            # Solved by another server; what this one uses is the solution.
            out[f"{prefix}_owner"] = window[0] // axis.per_server
    for name, hz in WIDTHS.items():
        if name in p:
            out[name] = p[name]
        elif hz in p:
            out[name] = width_in_channels(axis, name, p[hz], out.get("rfi_average_freq", 1))
        else:
            raise ValueError(f"neither {name} nor {hz} is given")
    for name, kind in PLAIN.items():
        if name not in p:
            raise ValueError(f"{name} is not given")
        out[name] = server_share(p[name], axis.servers) if name in SHARED else kind(p[name])
    return out


def published(axis: Axis, local: dict) -> dict:
    """Local values as global ones under ``param_`` names; splines stay private."""
    out = {}
    for name, value in local.items():
        if name.endswith("chan"):
            value = to_global(axis, value)
        elif name in SHARED:
            value = value * axis.servers
        if not name.startswith("bcross_sky") and not name.endswith("_owner"):
            out[f"param_{name}"] = value
    return out
