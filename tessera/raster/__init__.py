"""Kernels over pixels in numpy: fills, contours, warps, colours, blends. Images are BGR, uint8."""
