"""Streaming: applying fitted, stateless encoders to arriving rows.

The reference is batch only (no watermark, window or state).  What carries
over to a stream is the scoring path of held-out rows: a fitted encoder table
is static, so a stream-static join applies it to each micro-batch; nothing is
accumulated in state.
"""
