from tillscope.functions.cleaning import channel_of, hour_bucket, pad_zip, parse_price

__all__ = ["channel_of", "hour_bucket", "pad_zip", "parse_price"]
