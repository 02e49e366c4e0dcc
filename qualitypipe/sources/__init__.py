"""CSV scans."""
