"""Payload codecs. Plain Spark has no gzip or raw snappy expression, so these
are Python functions; callers apply them to the values that need them only.
They take a value at a time: a worker holds a hundred values, where Arrow batches
hold ten thousand, in four copies, whatever the values weigh."""

from pyspark.sql import functions as F, types as T

from rowtide.schema import GZIP_BASE64, SNAPPY, SNAPPY_BASE64

HUFFMAN_ONLY = -2


def _packer():
    """Function (data, mode, level) -> bytes. Built here, so that it
    travels to executors whole."""
    import zlib

    import pyarrow as pa

    snappy_modes, huffman = (SNAPPY, SNAPPY_BASE64), HUFFMAN_ONLY

    def gzip(data, level):
        strategy = zlib.Z_HUFFMAN_ONLY if level == huffman else zlib.Z_DEFAULT_STRATEGY
        packer = zlib.compressobj(-1 if level == huffman else level, zlib.DEFLATED, 31, 8, strategy)
        return packer.compress(data) + packer.flush()

    def pack(data, mode, level):
        if data is None:
            return None
        if mode in snappy_modes:
            return pa.Codec("snappy").compress(bytes(data), asbytes=True)
        return gzip(bytes(data), int(level))

    return F.udf(pack, T.BinaryType(), useArrow=False)


def _unpacker():
    """Function (data, mode) -> bytes."""
    import zlib

    import pyarrow as pa

    snappy_modes = (SNAPPY, SNAPPY_BASE64)

    def plain_size(data):
        """Uncompressed length: the varint a raw snappy block starts with."""
        size = shift = 0
        for byte in data:
            size |= (byte & 0x7F) << shift
            if byte < 0x80:
                return size
            shift += 7
        return size

    def unpack(data, mode):
        if data is None:
            return None
        if mode in snappy_modes:
            return pa.Codec("snappy").decompress(bytes(data), decompressed_size=plain_size(data), asbytes=True)
        return zlib.decompress(bytes(data), 31)

    return F.udf(unpack, T.BinaryType(), useArrow=False)


def level_ok(level):
    """Levels the gzip writer accepts."""
    return level.between(HUFFMAN_ONLY, 9)


def compress(text, mode, level):
    """Bytes of a text in a mode column 0..4; mode 0 is the text itself."""
    packed = _packer()(F.when(mode > 0, text.cast("binary")), mode, level)
    return (
        F.when(mode == 0, text.cast("binary"))
        # Some Spark versions break base64 text into lines.
        .when(mode.isin(GZIP_BASE64, SNAPPY_BASE64), F.translate(F.base64(packed), "\r\n", "").cast("binary"))
        .otherwise(packed)
    )


def decompress(data, mode):
    """The text of bytes made by `compress`."""
    packed = F.when(mode.isin(GZIP_BASE64, SNAPPY_BASE64), F.unbase64(data.cast("string"))).otherwise(
        F.when(mode > 0, data))
    return F.when(mode == 0, data.cast("string")).otherwise(_unpacker()(packed, mode).cast("string"))
