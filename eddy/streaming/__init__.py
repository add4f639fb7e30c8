from .runner import ChunkedStream, split_sink  # noqa: F401
