"""Plans: parameter resolution and the tag-driven calibration of a batch of scans."""
