from millrace.streaming.landing import land_stream

__all__ = ["land_stream"]
