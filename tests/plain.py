"""Small restatements of the rules in plain Python, to compare results with."""

from __future__ import annotations

from collections import defaultdict


def pack(rows, seconds):
    """Segments of caption rows (video_id, seq, start, duration, text)."""
    videos = defaultdict(list)
    for row in rows:
        videos[row[0]].append(row[1:])
    found = []
    for video, lines in videos.items():
        lines.sort(key=lambda line: line[0])
        bounds = [(0, 0.0)]
        for i, (_, start, _, _) in enumerate(lines):
            if start - bounds[-1][1] >= seconds:
                bounds.append((i, start))
        for k, (i, anchor) in enumerate(bounds):
            j, end = (
                bounds[k + 1]
                if k + 1 < len(bounds)
                else (len(lines), lines[-1][1] + (lines[-1][2] or 0.0))
            )
            text = " ".join(line[3] for line in lines[i:j]).strip()
            if text:
                found.append((video, anchor, end, text))
    return sorted(found)


def cut(duration, seconds):
    """Fixed-interval bounds of one video."""
    bounds, number = [], 0
    while number * seconds < duration:
        start = float(number * seconds)
        bounds.append((start, min(start + seconds, duration)))
        number += 1
    return bounds


def tagged(response):
    """Question and answer of a response."""
    last = {"Question:": "", "Answer:": ""}
    for line in response.split("\n"):
        line = line.strip()
        for tag in last:
            if line.startswith(tag):
                last[tag] = line.replace(tag, "").strip()
    question, answer = last.values()
    return (question, answer) if question and answer else (None, None)


def jaccard(first, second):
    a, b = set(first.lower().split()), set(second.lower().split())
    return len(a & b) / len(a | b) if a and b else 0.0


def clock(seconds):
    whole = int(seconds)
    return f"{whole // 3600:02d}:{whole % 3600 // 60:02d}:{whole % 60:02d}"
