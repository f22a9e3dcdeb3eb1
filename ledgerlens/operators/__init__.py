"""DataFrame-to-DataFrame operators.

They are lazy, but for the size checks that decide a broadcast (screening, as-of reads),
which aggregate the small side.
"""
