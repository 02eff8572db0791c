"""The same contracts on Structured Streaming."""

from clearbrook.streaming.loads import dedupe_stream, start_contract_stream, start_dedupe_stream, stream_table
