from tidebook.streaming.orders import order_stream, run_incremental  # noqa: F401
