"""Writers; every one replaces what an earlier build left."""
