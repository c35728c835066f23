"""Incremental (availableNow) runs of the file -> bronze -> silver streams."""
