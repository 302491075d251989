"""Settings of the detection rules and of the jobs around them."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # ---- fixed values of the rules ----------------------------------------
    watermark_s: int = 60
    tolerance_s: int = 120
    trigger: str = "10 seconds"
    max_offsets_per_trigger: int = 10_000
    # -----------------------------------------------------------------------

    # "position" measures the road by kilometre marker; "camera_id" uses the id
    # itself as the kilometre, so cameras missing from the dimension pair too.
    road_axis: str = "position"

    # Width of a join bin in tolerances. A start row is copied into the next bin
    # only if it lies in the last tolerance of its own, so copies cost 1/bin_span.
    bin_span: int = 4

    # Groups of (plate, bin) with more rows than this on a side are split by camera order,
    # and what is still larger by salt.
    split_hot_groups: bool = True
    hot_group_rows: int = 20_000
    # Salts of a plate that a stream is told to be hot.
    hot_salts: int = 32

    @property
    def bin_width_s(self) -> int:
        return self.tolerance_s * self.bin_span


# The largest dimension that is broadcast; rows are narrow (about 40 bytes), so
# this is some 4 MB. Larger ones are joined with a shuffle.
BROADCAST_ROWS = 100_000
