"""Writers of finished sets."""
