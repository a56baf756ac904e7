from tidemark.streaming.scoring import read_stream_output, request_stream, score_stream

__all__ = ["read_stream_output", "request_stream", "score_stream"]
