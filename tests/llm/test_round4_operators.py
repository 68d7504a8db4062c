"""Training-data operators: findings of round 4."""

from __future__ import annotations

import numpy as np

from lociq.llm import media_copies


def test_pictures_described_together_are_described_as_alone():
    images = [media_copies.picture(k) for k in range(9)] + [media_copies.picture(9)[:61, 7:90], np.full((50, 40), 7.0), np.zeros((12, 12))]
    together = media_copies.describe_all(images)
    assert [f.tobytes() for f in together] == [media_copies.describe(image).tobytes() for image in images]
    assert len(together[0]) > 40 and not len(together[-1])


def test_pictures_meet_by_one_rule_in_short_and_long_lists(spark, monkeypatch):
    """A pair that shares one entry is not compared, however many pictures have it, and lists find the groups that counting finds."""
    keys = lambda a: set(media_copies.table_keys(media_copies.describe(media_copies.read_image(media_copies.as_pgm(a)))).tolist())
    whole = [media_copies.picture(seed) for seed in range(20, 32)]
    crops = [(k, a[y : y + 40, y : y + 40]) for k, a in enumerate(whole) for y in range(0, 56, 5)]
    k, once = next((k, c) for k, c in crops if len(keys(c) & keys(whole[k])) == 1)
    shown = {0: whole[k], 1: once, 2: np.rot90(whole[k])} | {10 + i: a for i, a in enumerate(whole) if i != k} | {30 + i: a[5:, 3:] for i, a in enumerate(whole) if i != k}
    entries = {i: keys(a) for i, a in shown.items()}
    media = spark.createDataFrame([(i, media_copies.as_pgm(a)) for i, a in shown.items()], "media_id long, image binary")
    verified, groups = media_copies._verified, []
    for full in (media_copies.FULL, 1):
        seen = []

        def compared(pairs, features, agree, seen=seen):
            seen += [(r.a, r.b) for r in pairs.collect()]
            seen_features.append(features)
            return verified(pairs, features, agree)

        seen_features = []
        monkeypatch.setattr(media_copies, "FULL", full)
        monkeypatch.setattr(media_copies, "_verified", compared)
        groups.append({r.media_id: r.group_id for r in media_copies.media_groups(media).collect()})
        digest = {f.tobytes(): i for i, f in zip(shown, media_copies.describe_all([media_copies.read_image(media_copies.as_pgm(a)) for a in shown.values()]), strict=True)}
        media_of = {r.cls: digest[bytes(r.features)] for r in seen_features[0].collect()}
        assert seen and all(len(entries[media_of[a]] & entries[media_of[b]]) >= media_copies.SHARED for a, b in seen)
    assert groups[0] == groups[1] and groups[0][2] == 0 and all(groups[0][30 + i] == 10 + i for i in range(len(whole)) if i != k)
