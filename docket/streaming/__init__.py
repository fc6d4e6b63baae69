from docket.streaming.event_state import LatestState, stream_latest_state  # noqa: F401
