"""Captions from aligned words: times are repaired, gaps interpolated, words dealt to paragraphs, and cues cut and joined.

Each segment is a few thousand words and each step depends on what the step before left, so a segment is one group of
applyInPandas; segments are independent of each other. The parts that are windows by nature have column forms in
sequences.py, and the tests hold both against each other."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

from storyloom.config import CaptionLimits

CUE_SCHEMA = "segment_id long, seq long, start long, end long, lines array<string>, speakers array<string>, problems array<string>"
_BRACKETED = re.compile(r"\[[^\]]*\]?|\([^)]*\)?")


@dataclass
class Word:
    text: str
    start: int
    end: int
    begin: int  # offsets into the transcript, later into the paragraph
    stop: int
    aligned: bool = True


@dataclass
class Line:
    speaker: str
    words: list[Word] = field(default_factory=list)

    @property
    def text(self) -> str:
        return "".join(w.text for w in self.words).strip()

    @property
    def span(self) -> int:
        return self.words[-1].end - self.words[0].start if self.words else 0


def clean(text: str) -> str:
    return re.sub(r" ([.,;:!?])", r"\1", re.sub(r"\s+", " ", _BRACKETED.sub("", text))).strip()


def repair_times(words: list[Word], duration: int) -> None:
    """In place, for aligned words: starts in order (the n-th word gets the n-th times), ends that overlap the next start are
    exchanged with it (the last pair is left as it is), and words past the end share what is left from the last good one on."""
    known = [w for w in words if w.aligned]
    if len(known) > 1:
        times = sorted(((w.start, i, w.end) for i, w in enumerate(known)), key=lambda t: t[:2])
        for w, (start, _, end) in zip(known, times, strict=True):
            w.start, w.end = start, end
        for one, two in zip(known[:-2], known[1:-1], strict=True):
            if one.end > two.start:
                one.end, two.start = two.start, one.end
    if known and known[-1].end > duration:
        good = max((i for i, w in enumerate(known) if w.end <= duration), default=0)
        spread(known[good:], known[good].start, duration)


def spread(words: list[Word], start: int, end: int) -> None:
    """Even shares of whole ms; what doesn't divide stays behind the last."""
    share = (end - start) // len(words)
    for i, w in enumerate(words):
        w.start, w.end = start + i * share, start + (i + 1) * share


def interpolate(words: list[Word], duration: int, limit: int) -> list[Word]:
    """Unaligned blocks are spread between their neighbours' times; one at the very end that is longer than the limit goes."""
    out, i = list(words), 0
    while i < len(out):
        if out[i].aligned:
            i += 1
            continue
        j = i
        while j < len(out) and not out[j].aligned:
            j += 1
        if j == len(out) and j - i > limit:
            return out[:i]
        spread(out[i:j], out[i - 1].end if i else 0, out[j].start if j < len(out) else duration)
        i = j
    return out


def deal(words: list[Word], transcript: str) -> list[tuple[str, list[Word]]]:
    """Paragraphs (cleaned text, words inside their offsets). Words are found again in the cleaned text by a cursor; then each
    takes a quotation mark before it, hyphenated neighbours become one, and a word reaches to the next one's beginning."""
    out, at, k = [], 0, 0
    for paragraph in transcript.split("\n\n"):
        end, mine = at + len(paragraph), []
        while k < len(words) and words[k].stop <= end:
            if words[k].begin >= at:
                mine.append(words[k])
            k += 1
        text, cursor, found = clean(paragraph), 0, []
        for w in mine:
            begin = text.find(w.text, cursor)
            if begin >= 0:  # a word inside brackets is gone from the text
                w.begin, w.stop, cursor = begin, begin + len(w.text), begin + len(w.text)
                found.append(w)
        joined: list[Word] = []
        for w in found:
            if w.begin and text[w.begin - 1] == '"':
                w.begin -= 1
            last = joined[-1] if joined else None
            if last and w.begin - last.stop == 1 and text[last.stop] == "-" and not getattr(last, "_pair", False):
                last.stop, last.end = w.stop, w.end
                last._pair = True  # a third part begins a word of its own
            else:
                joined.append(w)
        for w, following in zip(joined, [*joined[1:], None], strict=True):
            w.stop = following.begin if following else len(text)
            w.text = text[w.begin : w.stop]
        if joined:
            out.append((text, joined))
        at = end + 2
    return out


def cut(paragraphs: list[tuple[str, list[Word]]], limits: CaptionLimits) -> list[list[Line]]:
    """Cues of one line each. Speakers alternate by paragraph; the one who says much less is the interviewer, S1. A paragraph
    that is too long or lasts too long is filled greedily up to the target, and a short rest joins the line before."""
    said = [sum(len(t) for t, _ in paragraphs[k::2]) for k in (0, 1)]
    order = ("S2", "S1") if said[1] and said[0] // said[1] >= limits.speaker_ratio else ("S1", "S2")
    cues = []
    for i, (_, words) in enumerate(paragraphs):
        whole = Line(order[i % 2], words)
        if whole.span <= limits.max_cue_ms and len(whole.text) <= limits.max_cue_chars:
            cues.append([whole])
            continue
        line = Line(whole.speaker)
        for n, w in enumerate(words):
            line.words.append(w)
            rest = Line(whole.speaker, words[n + 1 :])
            if len(line.text) >= limits.target_chars or line.span >= limits.target_ms or not rest.words:
                if rest.words and rest.span < limits.min_cue_ms and rest.span + line.span < limits.max_cue_ms:
                    line.words += rest.words
                    cues.append([line])
                    line = Line(whole.speaker)
                    break
                cues.append([line])
                line = Line(whole.speaker)
    return cues


def _span(cue: list[Line]) -> int:
    return cue[-1].words[-1].end - cue[0].words[0].start


def coalesce(cues: list[list[Line]], limits: CaptionLimits) -> list[list[Line]]:
    """Cues that are too short join the shorter neighbour that has room, the one before if equal; a joined cue is looked at
    again. Lines of the same speaker that meet become one."""
    out, i = list(cues), 0
    while i < len(out):
        if _span(out[i]) >= limits.min_cue_ms:
            i += 1
            continue
        room = [j for j in (i - 1, i + 1) if 0 <= j < len(out) and _span(out[j]) + _span(out[i]) < limits.max_cue_ms and len(out[j]) < limits.max_lines]
        if not room:
            i += 1
            continue
        first = min(min(room, key=lambda j: _span(out[j])), i)
        joined: list[Line] = []
        for line in out[first] + out[first + 1]:
            if joined and joined[-1].speaker == line.speaker:
                joined[-1] = Line(line.speaker, joined[-1].words + line.words)
            else:
                joined.append(line)
        out[first : first + 2] = [joined]
        i = first + (first < i)  # where the cue before took it, the walk goes on behind that
    return out


def problems(cue: list[Line], following: list[Line] | None, limits: CaptionLimits) -> list[str]:
    found, span = [], _span(cue)
    if span < limits.min_cue_ms:
        found.append("too short")
    if span > limits.max_cue_ms:
        found.append("too long")
    if len(cue) > limits.max_lines:
        found.append("too many lines")
    if any(len(line.text) > limits.max_cue_chars for line in cue):
        found.append("too many characters")
    if any(not line.text for line in cue):
        found.append("empty line")
    if following and cue[-1].words[-1].end > following[0].words[0].start:
        found.append("overlap")
    return found


def cue_rows(words: list[Word], transcript: str, duration: int, limits: CaptionLimits) -> list[tuple]:
    repair_times(words, duration)
    cues = coalesce(cut(deal(interpolate(words, duration, limits.trailing_unaligned_words), transcript), limits), limits)
    return [(i, c[0].words[0].start, c[-1].words[-1].end, [x.text for x in c], [x.speaker for x in c], problems(c, n, limits)) for i, (c, n) in enumerate(zip(cues, [*cues[1:], None], strict=True))]


def captions(words: DataFrame, segments: DataFrame, limits: CaptionLimits = CaptionLimits()) -> DataFrame:
    """words (segment_id, seq, case, word, start, end, offset_start, offset_end) and segments (segment_id, transcript, duration)
    -> CUE_SCHEMA. A segment without words or transcript has no cues."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq")
        one = pdf.iloc[0]
        ws = [Word(r.word, int(r.start or 0), int(r.end or 0), int(r.offset_start), int(r.offset_end), r.case == "success") for r in pdf.fillna({"start": 0, "end": 0}).itertuples()]
        rows = cue_rows(ws, one.transcript or "", int(one.duration), limits)
        return pd.DataFrame([(one.segment_id, *r) for r in rows], columns=[c.split()[0] for c in CUE_SCHEMA.split(", ")])

    joined = words.select("segment_id", "seq", "case", "word", "start", "end", "offset_start", "offset_end").join(segments.select("segment_id", "transcript", "duration"), "segment_id")
    return joined.groupBy("segment_id").applyInPandas(run, CUE_SCHEMA)
