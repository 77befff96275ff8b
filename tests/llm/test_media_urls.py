"""Audio payloads and features; URL rules and models."""

import hashlib
import zlib

import numpy as np
import pytest

from glossaflow.llm import audio, urls


def test_payloads_come_back_as_stored(frame, odd_texts):
    docs = frame(odd_texts)
    got = audio.features(audio.store(audio.of_texts(docs))).collect()
    assert len(got) == len(odd_texts)
    texts = {i: t for i, t in odd_texts}
    for r in got:
        data = (texts[r["doc_id"]] or "").encode()
        padded = data + b" " * (-len(data) % 192 or (192 if not data else 0))
        media = audio.wav_bytes(padded, 16_000)
        assert r["n_bytes"] == len(data) and r["payload_bytes"] == len(padded) > 0
        assert r["payload_sha256"] == hashlib.sha256(padded).hexdigest()
        assert r["tail_crc32"] == zlib.crc32(padded[-16:])
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())
        tensor = audio.read_tensor(bytes(r["tensor"]))
        assert tensor.shape[1:] == (16, 24) and len(tensor) == len(r["spans"])
    same = {(r["feature"], r["payload_sha256"]) for r in got if r["doc_id"] in (1, 2)}
    assert len(same) == 1
    assert audio.features(audio.store(audio.of_texts(docs.limit(0)))).count() == 0


def test_blocks_change_nothing(monkeypatch):
    payload = bytes(np.random.default_rng(0).integers(0, 256, 192 * 400, dtype=np.uint8))
    for settings in (audio.Settings(), audio.Settings(up=3, down=2)):
        whole = audio.describe(payload, settings)
        monkeypatch.setattr(audio, "BLOCK", 37)
        parts = audio.describe(payload, settings)
        monkeypatch.undo()
        assert parts["segments"] == whole["segments"]
        assert np.allclose(audio.read_tensor(parts["tensor"]), audio.read_tensor(whole["tensor"]), atol=1e-2)


def test_resampling_keeps_a_tone():
    t = np.arange(4000)
    for up, down in ((1, 2), (3, 2), (2, 3)):
        y = audio.resample(np.sin(t * 0.05), audio.Settings(up=up, down=down), 0, 1500)
        expected = np.sin((np.arange(1500) * down / up) * 0.05 + 0.025 / up)
        assert np.abs(y - expected)[50:-50].max() < 0.05


def test_segments_have_hysteresis():
    s = audio.Settings()
    levels = np.array([-60, -20, -25, -29, -31, -25, -20, -60.0])
    for blocks, found in (([levels[:3], levels[3:]], [(1, 4), (6, 7)]), ([np.array([-10.0, -25.0])], [(0, 2)])):
        sound = audio.Segments(s)
        for block in blocks:
            sound.add(block)
        assert sound.all() == found


def test_features_equal_direct_sums(frame, monkeypatch):
    """Resampling, filterbank and energy of whole payloads, sum by sum."""
    s = audio.Settings()
    taps = s.taps
    t = np.arange(taps) - (taps - 1) / 2
    h = np.sinc(t / 2) / 2 * np.hamming(taps)
    h /= h.sum()
    monkeypatch.setattr(audio, "BATCH_BYTES", 2_000)
    rows = [(i, "some words " * n) for i, n in ((1, 3), (2, 150), (3, 400), (4, 1))]
    got = {r["doc_id"]: r for r in audio.features(audio.store(audio.of_texts(frame(rows)))).collect()}
    for i, text in rows:
        data = text.encode()
        data += b" " * (-len(data) % 192)
        x = (np.frombuffer(data, np.uint8).astype(float) - 128) / 128
        n = max(s.frame, -(-len(x) // 2))
        frames = 1 + max(0, -(-(n - s.frame) // s.hop))
        total = (frames - 1) * s.hop + s.frame
        y = np.array([sum(h[taps - 1 - k] * x[j] for k in range(taps) if 0 <= (j := 2 * m - (taps - 1) // 2 + k) < len(x)) for m in range(total)])
        mel = 700 * (10 ** (np.linspace(0, 2595 * np.log10(1 + s.rate / 4 / 700), s.bands + 2) / 2595) - 1)
        bins = np.arange(s.frame // 2 + 1) * s.rate / 2 / s.frame
        table, energies = [], []
        for f in range(frames):
            w = y[f * s.hop : f * s.hop + s.frame]
            energies.append(10 * np.log10(max(0.0, float(np.mean(w**2) - np.mean(w) ** 2)) + 1e-10))
            wave = w * np.hanning(s.frame)
            power = [abs(sum(wave * np.exp(-2j * np.pi * k * np.arange(s.frame) / s.frame))) ** 2 for k in range(s.frame // 2 + 1)]
            row = []
            for b in range(s.bands):
                low, mid, high = mel[b : b + 3]
                row.append(np.log(sum(p * max(0.0, min((f0 - low) / (mid - low), (high - f0) / (high - mid))) for p, f0 in zip(power, bins, strict=True)) + 1e-10))
            table.append(row)
        table, sound = np.array(table), audio.Segments(s)
        sound.add(np.array(energies))
        spans = sound.all()
        counts, means = got[i]["feature"].split("|")[:3], [float(v) for v in got[i]["feature"].split("|")[3].split(",")]
        assert counts == [str(frames), str(len(spans)), str(sum(b - a for a, b in spans))]
        assert np.allclose(means, [*table.mean(0), *table.std(0)], atol=2e-4)
        tensor = audio.read_tensor(bytes(got[i]["tensor"])).reshape(-1, s.bands)[:frames]
        assert np.allclose(tensor, table, atol=2e-2)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "v") for i, u in enumerate(rows)], "page_id long, url string, verdict string")


def test_rules(spark):
    rows = ["http://a.example.org/es/1", "http://example.org/en/12", "http://EXAMPLE.org/fr/", "http://x.com/fr/a?b", "http://x.com/de/", "http://org", "http://notorg/x", "x://a.COM/de/#f", "no scheme", "", None, "http://example.org/en/2"]
    got = urls.filter_urls(pages(spark, rows)).orderBy("page_id").collect()
    assert [r["rule"] for r in got] == ["example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", None, None, "com/de/", None, None, None, "org/"]
    assert [r["verdict"] for r in got if r["rule"]] == ["block", "block", "allow", "allow", "block", "block", "allow"]
    assert (got[3]["host"], got[3]["path"]) == ("x.com", "/fr/a") and (got[8]["host"], got[10]["path"]) == ("", "")
    assert {r["verdict"] for r in got} <= {"allow", "block"}
    assert urls.filter_urls(pages(spark, rows).limit(0)).count() == 0


def test_models_tell_unseen_urls_apart(spark):
    rows = [f"http://s{i}.example.org/fr/page-{i}" for i in range(60)] + [f"http://s{i}.com/de/seite-{i}" for i in range(60)] + ["http://q.net/fr/page-7", "http://q.net/de/seite-7", "http://q.net/fr/" + "page-" * 20_000]
    got = urls.filter_urls(pages(spark, rows)).orderBy("page_id").collect()
    assert [r["verdict"] for r in got[-3:]] == ["allow", "block", "allow"]
    one_sided = urls.filter_urls(pages(spark, rows[:60] + ["http://q.net/x"])).where("rule is null").first()
    assert one_sided["verdict"] in ("allow", "block")


@pytest.mark.parametrize("rules", [[("allow", "net", "/")], []])
def test_other_rules(spark, rules):
    got = urls.filter_urls(pages(spark, ["http://a.net/x", "http://b.org/y"]), rules).collect()
    assert sum(r["rule"] is not None for r in got) == len(rules)
