from .stream import score_stream, windowed_verdicts, windowed_verdicts_stream

__all__ = ["score_stream", "windowed_verdicts", "windowed_verdicts_stream"]
