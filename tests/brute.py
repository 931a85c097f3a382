"""Straight-line Python statement of the detection rules, for comparison on small data."""

from collections import defaultdict

HOUR = 3600.0


def _less(m):
    def text(v):
        return (v is not None, v or "")

    return (m["timestamp"], text(m.get("msgid")), text(m.get("seg_id")))


def tracks_of(messages, keys=("ssvid",)):
    tracks = defaultdict(list)
    for m in messages:
        tracks[tuple(m[k] for k in keys)].append(m)
    return {k: sorted(v, key=_less) for k, v in tracks.items()}


def counts(track, off, n_hours):
    seen = [m for m in track if off["timestamp"] - n_hours * HOUR <= m["timestamp"] < off["timestamp"]]
    seen.append(off)
    of = lambda r: sum(m["receiver_type"] == r for m in seen)
    return (len(seen), of("terrestrial"), of("satellite"), of("dynamic"))


def run(messages, thr, n_hours=12, start=None, end=None, eval_last=True, known_open=(), keys=("ssvid",), since=None):
    """Set of (key, kind, off, on, counts); instants are epoch seconds."""
    out = {}
    if end is not None:
        messages = [m for m in messages if m["timestamp"] < end]
    earliest = since if start is None else start - thr * HOUR
    tracks = tracks_of(messages, keys)
    picks = {}
    for g in known_open:
        k = tuple(g[c] for c in keys)
        if k not in picks or (g["start_timestamp"], g["gap_id"]) > (picks[k]["start_timestamp"], picks[k]["gap_id"]):
            picks[k] = g
    for key, track in tracks.items():
        ok = lambda m: earliest is None or m["timestamp"] >= earliest
        if start is not None and key in picks:
            first = next((m for m in track if m["timestamp"] >= start), None)
            if first is not None:
                out[key, picks[key]["gap_id"]] = ("close", picks[key]["start_timestamp"], first, None)
        for a, b in zip(track, track[1:]):
            if b["timestamp"] - a["timestamp"] > thr * HOUR and ok(a):
                out[key, (a["timestamp"])] = ("pair", a, b, counts(track, a, n_hours))
        last = track[-1]
        midnight = end if end is not None else (last["timestamp"] // 86400 + 1) * 86400
        if eval_last and midnight - last["timestamp"] > thr * HOUR and ok(last):
            out[key, (last["timestamp"])] = ("open", last, None, counts(track, last, n_hours))
    return out
