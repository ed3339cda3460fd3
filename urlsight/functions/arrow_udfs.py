"""Arrow-batched pandas UDFs (the only Python-side row work outside of metrics by matrix products)."""
from pyspark.sql import Column
from pyspark.sql import functions as F


def char_entropy(text: Column) -> Column:
    """Base-2 code-point entropy per text, rounded to 9 dp (see url.text_entropy).

    The function is defined here and sent as a whole: the workers import
    nothing of this package.
    """
    import numpy as np
    import pandas as pd

    def entropy(texts):
        out = np.zeros(len(texts))
        for i, t in enumerate(texts):
            if t:
                codes = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                top = int(codes.max())
                # most texts stay within the first planes' low end: count directly, else by sorting
                n = np.bincount(codes) if top < 1 << 16 else np.unique(codes, return_counts=True)[1]
                p = n[n > 0] / len(codes)
                out[i] = round(float(-(p * np.log2(p)).sum()), 9) + 0.0
        return pd.Series(out)

    entropy.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(entropy, "double")(text)
