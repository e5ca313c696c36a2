"""The readings of messy titles, against all steps written out for one row."""

from __future__ import annotations

import itertools
import re

from curatrix.plans import catalogue

WORDS = "official|video|lyric|channel|topic|hd|4k|audio|preview"
TITLE = (rf"(?i)\s*\[[^\]]*(?:{WORDS})[^\]]*\]", rf"(?i)\s*\([^)]*(?:{WORDS})[^)]*\)", r"(?i)\s*[-–—]\s*(?:official|video|lyric|audio)\b.*$", r"(?i)\s*\|\s*(?:official|video|lyric|audio|channel|topic).*$", r"\s+#\S+.*$")
ARTIST = (r"\s*\|\s*.*$", r"(?i)\s*\(.*?(?:official|video|channel|topic|music|remix).*$", r"(?i)\s+(?:actual life|junos 365 sessions|disney channel animation|volume \d+|official|topic).*$")


def clean(value, *steps):
    value = " ".join(value.split())
    for step in steps:
        value = re.sub(step, "", value)
    return " ".join(value.split())


def splits(title):
    for s in (" - ", " | ", " : "):
        left, found, right = title.partition(s)
        if found:
            yield clean(left), clean(right), f"split:{s}:left=artist", f"split:{s}:left=title"
    guest = re.search(r"(?i)\s+(?:feat\.?|featuring|ft\.?)(?:\s+|\b)", title)
    if guest:
        yield clean(title[: guest.start()]), clean(title[guest.end() :]), "feat_split", "feat_split_reversed"


def readings(title, artist):
    title, artist = clean(title), clean(artist)
    bare, name = clean(title, *TITLE), clean(artist, *ARTIST)
    found = [(bare, name, "current_cleaned"), (title, name, "raw_title_cleaned_artist"), (bare, artist, "cleaned_title_raw_artist")]
    for left, right, note, backwards in splits(title):
        for x, y, n in ((left, right, note), (right, left, backwards)) if left and right else ():
            found += [(clean(x, *TITLE), clean(y, *ARTIST), n), (clean(x, *TITLE), y, f"{n}_artist_raw"), (x, clean(y, *ARTIST), f"{n}_title_raw")]
    found += [(bare, name, "title_noise_stripped")] if bare != title else []
    return list(enumerate(x for x in dict.fromkeys(found) if x[0]))


def queried(spark, path, names, brands):
    rows = [(i, n, b, "x", 1, 1.0) for i, (n, b) in enumerate(itertools.product(names, brands))]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{path}/part.parquet")
    got = {i: [] for i, *_ in rows}
    for r in catalogue.QUERIES["title_candidates"](spark, str(path)).collect():
        got[r["id"]].append((r["position"], (r["cand_title"], r["cand_artist"], r["note"])))
    return [(f"{b} - {n}", b, sorted(got[i])) for i, n, b, *_ in rows]


def test_the_query_gives_every_reading_of_each_title(spark, tmp_path):
    names = ["plain", "Song - Live", "Left | Right", "Left : Right", "a - b | c : d", "Song ft. Guest", "Song FEATURING Guest [HD]", "Song (Official Video)", "Song | Official Audio", "Song - video #tag x", "Song feat.", "(video)", ""]
    found = queried(spark, tmp_path, names, ["Brand#7", "Two  Words Topic", "Band | Label", "X (Official Channel)", "Y volume 3", ""])
    for title, artist, got in found:
        assert got == readings(title, artist), (title, artist)
    notes = {c[2] for *_, got in found for _, c in got}
    assert len(notes) == 3 + 4 * 6 + 1


def test_letters_and_numbers_beyond_ascii(spark, tmp_path):
    names = ["Şarkı (OFFİCİAL VİDEO)", "Song [vıdeo]", "Song (4K)", "Song | Lyrıc", "Song - audio² x", "Song - vidéo", "Song - audió x", "Song - videoé", "Song ft² x", "Song feat.² x", "Song feat́ x", "Song FEATURİNG x"]
    for title, artist, got in queried(spark, tmp_path, names, ["Band", "Band volume ٣", "Band OFFİCİAL", "Band (Remıx)"]):
        assert got == readings(title, artist), (title, artist)
