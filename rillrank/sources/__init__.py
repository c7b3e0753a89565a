"""Line sources."""
