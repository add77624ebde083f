"""Waveforms in NumPy: WAV bytes to mono float samples, slices, resampling, log-power spectra, WAV writing."""

from __future__ import annotations

import struct

import numpy as np

RATE = 16_000


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """(float32 mono samples between -1 and 1, rate) of a RIFF file with integer PCM of 8 to 32 bits or floats; channels are averaged."""
    if content[:4] != b"RIFF" or content[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, form = 12, None
    while at + 8 <= len(content):
        name, size = content[at : at + 4], struct.unpack_from("<I", content, at + 4)[0]
        body = at + 8
        if name == b"fmt ":
            form = struct.unpack_from("<HHIIHH", content, body)
            if form[0] == 0xFFFE:
                form = (struct.unpack_from("<H", content, body + 24)[0], *form[1:])
        elif name == b"data":
            if form is None:
                raise ValueError("no format before the data")
            kind, channels, rate, _, _, bits = form
            raw = content[body : body + min(size, len(content) - body)]
            width = bits // 8
            raw = raw[: len(raw) // (width * channels) * width * channels]
            if kind == 3 and bits in (32, 64):
                x = np.frombuffer(raw, f"<f{width}").astype(np.float32)
            elif kind == 1 and bits == 8:
                x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
            elif kind == 1 and bits == 16:
                x = np.frombuffer(raw, "<i2").astype(np.float32) / 32768
            elif kind == 1 and bits == 24:
                b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
                x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float32) / (1 << 23)
            elif kind == 1 and bits == 32:
                x = (np.frombuffer(raw, "<i4") / float(1 << 31)).astype(np.float32)
            else:
                raise ValueError(f"unsupported WAV format {kind} of {bits} bits")
            return (x.reshape(-1, channels).mean(axis=1) if channels > 1 else x), rate
        at = body + size + size % 2
    raise ValueError("no data")


def encode_wav(samples: np.ndarray, rate: int = RATE) -> bytes:
    """A 16-bit mono WAV file."""
    body = (np.clip(samples, -1, 1) * 32767).round().astype("<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate * 2, 2, 16) + b"data" + struct.pack("<I", len(body)) + body


def resample(samples: np.ndarray, rate: int, to: int = RATE) -> np.ndarray:
    """Band-limited resampling by the Fourier transform of the whole signal."""
    if rate == to or not len(samples):
        return samples.astype(np.float32)
    n = max(1, round(len(samples) * to / rate))
    spectrum = np.fft.rfft(samples)
    kept = np.zeros(n // 2 + 1, complex)
    m = min(len(kept), len(spectrum))
    kept[:m] = spectrum[:m]
    if n < len(samples) and n % 2 == 0:
        kept[-1] = kept[-1].real
    return (np.fft.irfft(kept, n) * (n / len(samples))).astype(np.float32)


def resample_polyphase(samples: np.ndarray, rate: int, to: int = RATE, zeros: int = 10, beta: float = 5.0) -> np.ndarray:
    """Resampling by a windowed sinc of ``zeros`` zero crossings to either side, of which each output sample uses one phase."""
    if rate == to or not len(samples):
        return samples.astype(np.float32)
    common = int(np.gcd(rate, to))
    up, down = to // common, rate // common
    slow = max(up, down)
    half = zeros * slow
    k = np.arange(-half, half + 1)
    h = np.sinc(k / slow) * np.kaiser(2 * half + 1, beta)
    h *= up / h.sum()
    at = np.arange(-(-len(samples) * up // down)) * down  # places of the outputs among the samples and the zeros between them
    first = -((half - at) // up)  # the first sample within reach
    tap = np.arange(2 * half // up + 1)
    source = first[:, None] + tap
    place = at[:, None] - source * up + half
    good = (source >= 0) & (source < len(samples)) & (place >= 0) & (place <= 2 * half)
    x = np.asarray(samples, np.float64)
    return np.where(good, x[np.clip(source, 0, len(samples) - 1)] * h[np.clip(place, 0, 2 * half)], 0.0).sum(axis=1).astype(np.float32)


def read_wav_span(path: str, start: float, end: float) -> tuple[np.ndarray, int]:
    """(mono samples, rate) between two times of a WAV file, of which only the header and that span are read."""
    with open(path, "rb") as f:
        head = f.read(12)
        if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
            raise ValueError("not a WAV file")
        form = None
        while len(mark := f.read(8)) == 8:
            name, size = mark[:4], struct.unpack("<I", mark[4:])[0]
            if name == b"data":
                if form is None:
                    raise ValueError("no format before the data")
                _, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", form)
                wide = channels * bits // 8
                a, b = (min(max(0, int(x * rate)), size // wide) for x in (start, end))
                f.seek(a * wide, 1)
                body = f.read(max(0, b - a) * wide)
                return decode_wav(b"RIFF\0\0\0\0WAVEfmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(body)) + body)
            body = f.read(size + size % 2)
            if name == b"fmt ":
                form = body[:size]
    raise ValueError("no data")


def cut(samples: np.ndarray, start: float, end: float, rate: int = RATE, mode: str = "truncate") -> np.ndarray:
    """Samples between two times; ``truncate`` cuts frame numbers off, ``round`` rounds and clamps them."""
    if mode == "truncate":
        a, b = int(start * rate), int(end * rate)
    elif mode == "round":
        a, b = (min(max(0, round(x * rate)), len(samples)) for x in (start, end))
    else:
        raise ValueError(f"unknown mode {mode}")
    return samples[max(0, a) : max(0, b)]


def log_power(samples: np.ndarray, size: int = 320, hop: int = 160) -> np.ndarray:
    """(frames, size / 2 + 1): log10 of the power spectrum of Hann windows, the signal padded by half a window on both sides."""
    x = np.pad(np.asarray(samples, np.float64), size // 2)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    frames = np.lib.stride_tricks.sliding_window_view(x, size)[::hop]
    power = np.abs(np.fft.rfft(frames * window, axis=1) / window.sum()) ** 2
    return np.log10(np.maximum(power, 1e-12))


def pad_to(samples: np.ndarray, length: int, padding: str) -> np.ndarray:
    """Short samples repeated to at least ``length``: by doubling or as a tile."""
    if not len(samples) or len(samples) >= length:
        return samples
    if padding == "double":
        while len(samples) < length:
            samples = np.concatenate([samples, samples])
        return samples
    if padding == "tile":
        return np.tile(samples, -(-length // len(samples)))
    raise ValueError(f"unknown padding {padding}")


def windows(samples: np.ndarray, padding: str = "double", seconds: int = 9, rate: int = RATE) -> list[np.ndarray]:
    """The scoring windows of one segment, a second apart."""
    if not len(samples):
        return []
    x = pad_to(samples, seconds * rate, padding)
    n = max(1, len(x) // rate - seconds + 1)
    return [x[k * rate : (k + seconds) * rate] for k in range(n)]
