"""Functions on arrays of audio samples."""

from __future__ import annotations

import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WAV = T.StructType([
    T.StructField("rate", T.IntegerType()),
    T.StructField("channels", T.IntegerType()),
    T.StructField("samples", T.ArrayType(T.ShortType())),
])


@F.pandas_udf(WAV)
def wav_samples(content: pd.Series) -> pd.DataFrame:
    """16-bit PCM samples of WAV bytes; nulls for a file that cannot be read."""
    def read(data):
        try:
            with wave.open(io.BytesIO(data)) as f:
                if f.getsampwidth() != 2:
                    return None, None, None
                return f.getframerate(), f.getnchannels(), np.frombuffer(f.readframes(f.getnframes()), "<i2")
        except (wave.Error, EOFError, TypeError):
            return None, None, None

    return pd.DataFrame([read(c) for c in content], columns=["rate", "channels", "samples"])


def pcm_to_float(samples: Column) -> Column:
    return F.transform(samples, lambda s: (s / F.lit(32768.0)).cast("float"))


def channel(samples: Column, number: int, channels: int = 2) -> Column:
    """One channel of interleaved samples."""
    return F.filter(samples, lambda _, i: i % channels == number)


def reflect_edges(samples: Column, pad: int) -> Column:
    """Mirror `pad` samples at both ends without repeating the outermost one."""
    last = F.greatest(F.size(samples) - pad, F.lit(1))
    return F.concat(F.reverse(F.slice(samples, 2, pad)), samples, F.reverse(F.slice(samples, last, pad)))


def frame_starts(samples: Column, hop: int) -> Column:
    return F.when(F.size(samples) > 0, F.sequence(F.lit(0), F.size(samples) - 1, F.lit(hop)))


def frame_at(samples: Column, start: Column, size: int) -> Column:
    """`size` samples from `start`, filled with zeros past the end."""
    part = F.slice(samples, start + 1, F.lit(size))
    return F.concat(part, F.array_repeat(F.lit(0).cast("float"), F.lit(size) - F.size(part)))
