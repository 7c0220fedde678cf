from pagedframes.streaming.pages import drain, stream_api, stream_items, stream_landed

__all__ = ["drain", "stream_api", "stream_items", "stream_landed"]
