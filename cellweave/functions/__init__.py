from cellweave.functions.geocoding import packed_lat, packed_lng, query_text, reply_point
from cellweave.functions.geohash import cell_id, cell_of_text, cell_text, geohash

__all__ = ["cell_id", "cell_of_text", "cell_text", "geohash", "packed_lat", "packed_lng", "query_text", "reply_point"]
